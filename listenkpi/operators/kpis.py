"""Per ``(date, track_genre)`` KPIs over the pre-aggregated listen table.

Input columns: ``date, track_genre, user_id, plays`` and ``duration_ms`` (``plays`` = number of
plays of the row's track by the row's user on that date). Every aggregate is partial before its
exchange: the distinct count of listeners is planned as a grouping on ``(date, track_genre,
user_id)`` (map-side combined) followed by a count, so a hot genre or a hot user never sends its
raw rows to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenkpi.functions.columns import ms_to_minutes, round2

KEYS = ["date", "track_genre"]


def _raw(listens: DataFrame) -> DataFrame:
    return listens.groupBy(*KEYS).agg(
        F.sum("plays").alias("listen_count"),
        F.countDistinct("user_id").alias("unique_listeners"),
        F.sum(F.col("plays") * F.col("duration_ms")).alias("total_listening_time_ms"),
    )


def genre_kpis(listens: DataFrame) -> DataFrame:
    """``date, track_genre, listen_count, unique_listeners, total_listening_time,
    avg_listening_time_per_user``: times in minutes, 2 decimals; the average is the total divided
    by the distinct listeners (divided first, rounded once). Times are NULL when no play of the
    group has a duration (the NULL-genre group of plays without a song)."""
    return kpis_from_totals(_raw(listens))


def kpis_from_totals(raw: DataFrame) -> DataFrame:
    """The same from counts, distinct listeners and total ms of each group."""
    total = F.col("total_listening_time_ms")
    return raw.select(
        *KEYS,
        "listen_count",
        "unique_listeners",
        round2(ms_to_minutes(total)).alias("total_listening_time"),
        round2(ms_to_minutes(F.try_divide(total, F.col("unique_listeners")))).alias("avg_listening_time_per_user"),
    )


def genre_kpis_per_play(listens: DataFrame) -> DataFrame:
    """Notebook meaning of the KPIs: ``total_listening_time`` in ms (long) and
    ``avg_play_duration_ms``, the mean duration per play among plays with a duration.
    ``listen_count`` counts plays with a non-NULL ``track_id``; NULL listeners are not counted."""
    has_track = F.col("track_id").isNotNull()
    has_duration = F.col("duration_ms").isNotNull()
    raw = listens.groupBy(*KEYS).agg(
        F.sum(F.when(has_track, F.col("plays")).otherwise(F.lit(0))).alias("listen_count"),
        F.countDistinct("user_id").alias("unique_listeners"),
        F.sum(F.col("plays") * F.col("duration_ms")).alias("total_listening_time"),
        F.sum(F.when(has_duration, F.col("plays"))).alias("_timed_plays"),
    )
    return raw.select(
        *KEYS,
        "listen_count",
        "unique_listeners",
        "total_listening_time",
        F.try_divide(F.col("total_listening_time"), F.col("_timed_plays")).alias("avg_play_duration_ms"),
    )
