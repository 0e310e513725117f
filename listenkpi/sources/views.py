"""Domain tables (plays, songs, users) derived from the driver's Parquet tables.


* view B (``orders``, the bench view): one play per line item; the listener is the order's
  customer, the track is the part, the play time is the ship date.
* view A (``events``): one play per event; the track is the ``k`` value in ``props``. Error events
  carry no listener (``user_id`` NULL), which the cleaning step drops.

Songs come from ``part``. Some song fields are NULL by rule, so the cleaning rules of the job have
work to do on real data: a PROMO part has no genre (filled with ``Unknown``), a part of size over 45
has no duration (dropped by the NULL drop, so its plays land in the NULL genre), and every LARGE part
is listed a second time under the genre ``LARGE`` (one track in two genres, so its plays fan out).
Users come from ``customer`` and ``nation``.

Every view reads whole tables; only the columns used are selected, so the Parquet scans prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plays_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View B: ``user_id, track_id, listen_time`` from line items and their orders."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_shipdate").alias("listen_time"),
    )


def plays_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View A: ``user_id, track_id, listen_time`` from events; error events have no listener."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "props", "ts")
    return ev.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
        F.col("ts").alias("listen_time"),
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs: ``track_id, track_name, artists, track_genre, duration_ms, popularity``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    duration = F.col("p_size").cast("bigint") * F.lit(7919)
    base = p.select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_type").alias("artists"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("track_genre"),
        F.when(F.col("p_size") <= 45, duration).alias("duration_ms"),
        F.floor("p_retailprice").alias("popularity"),
    )
    second_genre = p.where(F.col("p_type") == "LARGE").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_type").alias("artists"),
        F.col("p_type").alias("track_genre"),
        duration.alias("duration_ms"),
        F.floor("p_retailprice").alias("popularity"),
    )
    return base.unionByName(second_genre)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users: ``user_id, user_name, user_country`` from customers and their nation."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("n_name").alias("user_country"),
    )


PLAYS_VIEWS = {"orders": plays_orders, "events": plays_events}


def domain(spark: SparkSession, sf_dir: str, view: str = "orders") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(plays, songs, users)`` for a view name (``orders`` = view B, ``events`` = view A)."""
    return PLAYS_VIEWS[view](spark, sf_dir), songs(spark, sf_dir), users(spark, sf_dir)
