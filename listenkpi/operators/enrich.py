"""Time parsing and the plays-to-songs join.

``plays_with_songs`` is the literal row-level join of the job (one row per play and matching song
row). The KPI jobs do not join raw plays: ``listen_table`` first collapses the cleaned plays to one
row per ``(date, track_id, user_id)`` with a play count (map-side partial aggregate, then one
exchange), and joins that to the songs. Every KPI is a sum or a distinct count over that table, so
the results are the same, while the join's input shrinks by the number of repeat plays.

Join strategy: the songs side is a dimension. Spark broadcasts it when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks the real size at run time); beyond that
it falls back to a sort-merge join, where AQE's skew-join splits an oversized partition of the plays
side (a hot track) into several tasks. No broadcast hint is forced, so nothing unbounded is ever
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenkpi.functions.columns import parse_time
SONG_FIELDS = ["track_id", "track_name", "track_genre", "duration_ms"]


def with_date(plays: DataFrame) -> DataFrame:
    """Parse ``listen_time`` (text or timestamp) and add ``date``; a bad time gives NULL, not an error."""
    ts = parse_time("listen_time", plays.schema["listen_time"].dataType)
    return plays.withColumn("listen_time", ts).withColumn("date", F.to_date("listen_time"))


def join_songs(plays: DataFrame, songs: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """Left join on ``track_id``: plays without a song stay (NULL song fields); a track listed
    under several song rows yields one row per song row.

    Plays without a track match no song, but would all meet in one join task: they get a second key, a
    hash of their listener and time, which spreads them (the join keeps them as they are).

    ``salt_buckets``: for a song table too large to broadcast, spread every track over that many
    join tasks. Each play row takes one salt (the same hash, so a retried task computes the same salt),
    each song row is repeated once per salt, and the join runs on ``(track_id, salt)``: a track holding a
    third of the plays is split ``salt_buckets`` ways, the result is unchanged. The song side grows by the
    same factor, so use it only where it is needed."""
    n = max(1, int(salt_buckets or 1))
    spread = F.xxhash64(*[c for c in ("user_id", "date", "listen_time") if c in plays.columns])
    salted_plays = plays.withColumn("_salt", F.when(F.col("track_id").isNull(), spread).otherwise(F.pmod(spread, F.lit(n))))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) if n > 1 else F.lit(0).cast("long")
    return salted_plays.join(songs.withColumn("_salt", every), ["track_id", "_salt"], "left").drop("_salt")


def plays_with_songs(plays: DataFrame, songs: DataFrame) -> DataFrame:
    """Row-level merged table of the job: cleaned plays joined to cleaned songs, with ``date``."""
    return with_date(join_songs(plays, songs))


def daily_plays(plays: DataFrame) -> DataFrame:
    """Plays collapsed to ``(date, track_id, user_id, plays)``.

    ``plays`` counts rows (each row of the cleaned table is one play). The grouping keeps NULL keys,
    so a play with a bad time forms a NULL-date group."""
    return with_date(plays).groupBy("date", "track_id", "user_id").agg(F.count(F.lit(1)).alias("plays"))


def listen_table(plays: DataFrame, songs: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """Pre-aggregated plays joined to the song fields the KPIs use:
    ``date, track_id, user_id, plays, track_name, track_genre, duration_ms``."""
    return join_songs(daily_plays(plays), songs.select(*SONG_FIELDS), salt_buckets)
