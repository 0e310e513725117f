"""Rankings and ranked lists: top songs per (date, genre), top genres per date.

Ties are broken by name ascending (NULL first), so results are deterministic. ``row_number`` with a
``rank <= k`` filter lets Catalyst insert a ``WindowGroupLimit`` before the window's exchange: each
map task keeps at most ``k`` rows per group, so even a group holding a third of the rows shuffles
only ``k`` rows per task. The lists are built from at most ``k`` rows per group, sorted by rank
explicitly (``collect_list`` order alone is not defined after a shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.schemas import GENRE_LIST, LIST_SEPARATOR, SONG_LIST, TOP_GENRES, TOP_SONG, TOP_SONG_PLAYS, TOP_SONGS


def song_plays(listens: DataFrame, count_col: str = "plays") -> DataFrame:
    """Plays per ``(date, track_genre, track_name)``: tracks sharing a name and genre merge."""
    return listens.groupBy("date", "track_genre", "track_name").agg(F.sum(count_col).alias("play_count"))


def rank_within(df: DataFrame, keys: Sequence[str], measure: str, name_col: str, k: int) -> DataFrame:
    """Add ``rank`` (long, 1 = largest ``measure``, ties by ``name_col`` ascending) and keep ``rank <= k``."""
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), F.col(name_col).asc_nulls_first())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast(T.LongType())
    )


def top_songs(song_counts: DataFrame, k: int = TOP_SONGS) -> DataFrame:
    """``date, track_genre, top_3_songs, song_play_count, rank``: the k most played names per group."""
    ranked = rank_within(song_counts, ["date", "track_genre"], "play_count", "track_name", k)
    return ranked.select(
        "date",
        "track_genre",
        F.col("track_name").alias(TOP_SONG),
        F.col("play_count").alias(TOP_SONG_PLAYS),
        "rank",
    )


def top_genres(kpis: DataFrame, k: int = TOP_GENRES) -> DataFrame:
    """``date, track_genre, listen_count, rank``: the k genres with most plays per date. The NULL
    genre (plays without a song) takes part in the ranking like any other group."""
    ranked = rank_within(kpis.select("date", "track_genre", "listen_count"), ["date"], "listen_count", "track_genre", k)
    return ranked


def ranked_list(df: DataFrame, keys: Sequence[str], value: str, rank: str, name: str,
                sep: str = LIST_SEPARATOR) -> DataFrame:
    """One row per ``keys``: the ``value``s joined by ``sep`` in ``rank`` order. NULL values are
    skipped; a group of NULL values only gives ``""``."""
    items = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.concat_ws(sep, F.transform(items, lambda x: x["v"])).alias(name))


def top_songs_list(top: DataFrame) -> DataFrame:
    """``date, track_genre, top_3_songs_per_genre`` from ``top_songs``."""
    return ranked_list(top, ["date", "track_genre"], TOP_SONG, "rank", SONG_LIST)


def top_genres_list(top: DataFrame) -> DataFrame:
    """``date, top_5_genres_per_day`` from ``top_genres``."""
    return ranked_list(top, ["date"], "track_genre", "rank", GENRE_LIST)
