"""Checks that explain KPI numbers: tracks listed under several song rows (their plays count once
per row) and plays whose track has no song (they form the NULL-genre group)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ambiguous_tracks(songs: DataFrame) -> DataFrame:
    """``track_id, song_rows, genres`` for tracks with more than one (cleaned) song row."""
    return (
        songs.groupBy("track_id")
        .agg(F.count(F.lit(1)).alias("song_rows"), F.countDistinct("track_genre").alias("genres"))
        .where(F.col("song_rows") > 1)
    )


def plays_without_song(plays: DataFrame, songs: DataFrame) -> DataFrame:
    """Plays whose ``track_id`` matches no song row (left anti join; the song side is only keys)."""
    return plays.join(songs.select("track_id"), "track_id", "left_anti")
