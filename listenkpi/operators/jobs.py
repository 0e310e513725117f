"""The two full KPI jobs: the daily job (Q1) and its notebook variant (Q2).

Plan shape of ``daily_kpis`` (one Spark job, no driver round trip):

    plays -> dropna -> distinct (partial agg | exchange | final)
          -> parse time, group by (date, track, user) (partial | exchange | final)
          -> left join songs (broadcast when small, else sort-merge with AQE skew split)
          -> genre KPIs  (partial | exchange | final)         --+-- join on (date, genre)
          -> song plays  (partial | exchange | final) -> top 3 -+    (co-partitioned)
          -> genre KPIs -> top 5 per date -> list ---------------- join on date

Everything after the song join runs on aggregated data (days x genres x names), which is small
whatever the number of plays. The listen table feeds three branches; left lazy, Catalyst prunes and
infers filters differently in each branch, so their exchanges differ and the scan, the distinct and
the join would run three times. It is therefore written once to Parquet under the shared checkpoint
folder (``stage``), which also cuts the lineage: a lost executor re-reads it instead of recomputing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenkpi.operators.enrich import SONG_FIELDS, join_songs, listen_table, with_date
from listenkpi.operators.kpis import genre_kpis, genre_kpis_per_play
from listenkpi.operators.quality import clean_plays, clean_songs, fill_unknown
from listenkpi.operators.rank import song_plays, top_genres, top_genres_list, top_songs, top_songs_list
from listenkpi.schemas import GENRE_LIST, KPI_COLUMNS, SONG_LIST, TOP_GENRES, TOP_SONGS
from listenkpi.sources.sinks import stage

#: Sort keys of the job's result, by name: any table of KPI columns can be put in this order.
_ORDER = [("date", True), ("listen_count", False), ("track_genre", True)]

PER_PLAY_COLUMNS = [
    "date",
    "track_genre",
    "listen_count",
    "unique_listeners",
    "total_listening_time",
    "avg_play_duration_ms",
    SONG_LIST,
    GENRE_LIST,
]


def assemble(kpis: DataFrame, songs_by_name: DataFrame, k_songs: int, k_genres: int) -> DataFrame:
    """KPIs + top-song list (join on date and genre; NULL keys do not match) + top-genre list
    (join on date)."""
    t3 = top_songs_list(top_songs(songs_by_name, k_songs))
    t5 = top_genres_list(top_genres(kpis, k_genres))
    return kpis.join(t3, ["date", "track_genre"], "left").join(t5, "date", "left")


def final_order() -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in _ORDER]


def order_kpis(df: DataFrame) -> DataFrame:
    """Final order: date ascending, most plays first, genre name as tie-break."""
    return df.orderBy(*final_order())


def kpis_from_clean(plays: DataFrame, songs: DataFrame, k_songs: int = TOP_SONGS,
                    k_genres: int = TOP_GENRES, materialize: bool = True,
                    salt_buckets: int | None = None) -> DataFrame:
    """Q1 on plays and songs that are already cleaned (used by the incremental job).

    With ``materialize`` the pre-aggregated listen table is written once (``stage``) and the three
    branches read it; otherwise each branch plans its own copy of the scan, distinct and join."""
    listens = listen_table(plays, songs, salt_buckets)
    if materialize:
        listens = stage(listens, "listens")
    out = assemble(genre_kpis(listens), song_plays(listens), k_songs, k_genres)
    return out.select(*KPI_COLUMNS)


def daily_kpis(plays: DataFrame, songs: DataFrame, k_songs: int = TOP_SONGS, k_genres: int = TOP_GENRES,
               ordered: bool = True, materialize: bool = True, salt_buckets: int | None = None) -> DataFrame:
    """Q1, the daily job: clean, join, KPIs, top songs and genres; unique on ``(date, track_genre)``.
    ``salt_buckets`` splits hot tracks in the song join (see ``enrich.join_songs``)."""
    out = kpis_from_clean(clean_plays(plays), clean_songs(songs), k_songs, k_genres, materialize, salt_buckets)
    return order_kpis(out) if ordered else out


def daily_kpis_per_play(plays: DataFrame, songs: DataFrame, k_songs: int = TOP_SONGS,
                        k_genres: int = TOP_GENRES, ordered: bool = True, materialize: bool = True) -> DataFrame:
    """Q2, the notebook variant: songs filled only (no distinct, no drop), plays taken as they are
    (copies count twice, NULL listeners count as plays but not as listeners), total time in ms and
    the mean duration per play."""
    daily = with_date(plays).groupBy("date", "track_id", "user_id").agg(F.count(F.lit(1)).alias("plays"))
    listens = join_songs(daily, fill_unknown(songs).select(*SONG_FIELDS))
    if materialize:
        listens = stage(listens, "listens_per_play")
    counted = listens.withColumn("plays_with_track", F.when(F.col("track_id").isNotNull(), F.col("plays")).otherwise(0))
    out = assemble(genre_kpis_per_play(listens), song_plays(counted, "plays_with_track"), k_songs, k_genres)
    out = out.select(*PER_PLAY_COLUMNS)
    return order_kpis(out) if ordered else out
