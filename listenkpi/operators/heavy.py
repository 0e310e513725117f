"""The plays-to-songs join for heavy hitters: hot tracks by broadcast, the rest by key.

Only what is few by count is broadcast: the tracks with more than a share of the plays, and their song rows where
they are few as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenkpi.operators.enrich import join_songs
from listenkpi.sources.sinks import stage

#: A track with more than this share of the plays is hot; so many song rows of hot tracks are broadcast at most.
HOT_SHARE, HOT_ROWS = 0.01, 100_000


def hot_tracks(plays: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """``track_id`` of the tracks with more than ``share`` of the plays: fewer than ``1 / share`` of them. Counts are
    partial in each task, so a hot track is one row of each task's shuffle."""
    counts = plays.where("track_id IS NOT NULL").groupBy("track_id").agg(F.count(F.lit(1)).alias("plays"))
    counts = stage(counts, "track-counts")
    total = counts.agg(F.sum("plays").alias("n")).first()["n"] or 0
    return counts.where(F.col("plays") > share * total).select("track_id")


def join_songs_hot(plays: DataFrame, songs: DataFrame, share: float = HOT_SHARE, most_rows: int = HOT_ROWS) -> DataFrame:
    """``join_songs`` for song tables too large to broadcast and plays with heavy hitters. The few song rows of the hot
    tracks are broadcast, so their plays are joined where they lie and never shuffled; the rest is joined by
    key, and no song row is repeated. Hot tracks are fewer than ``1 / share``; should they have over ``most_rows`` song
    rows all the same, these aren't broadcast by hint, but joined as Spark sees fit. ``plays`` is read twice: stage it
    where it is expensive."""
    hot = stage(hot_tracks(plays, share), "hot-tracks")
    own = stage(songs.join(F.broadcast(hot), "track_id", "left_semi"), "hot-songs")
    few = own.count() <= most_rows
    of_hot = plays.join(F.broadcast(hot), "track_id", "left_semi").join(F.broadcast(own) if few else own, "track_id", "left")
    rest = join_songs(plays.join(F.broadcast(hot), "track_id", "left_anti"), songs.join(F.broadcast(hot), "track_id", "left_anti"))
    return of_hot.unionByName(rest)
