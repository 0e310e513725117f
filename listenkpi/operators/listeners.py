"""Distinct listeners that merge: bitmaps over dense listener numbers.

A count of distinct listeners can't be added up over drops, but sets of listeners can be merged. Each listener
gets a number once (dense, from 1, in a table that only grows), and the listeners of a (date, genre) are bitmaps of 32,768 numbers
each, of which the words of 64 bits that hold a listener are kept (``words``, their places, and ``bits``). So a bitmap takes 10 bytes for each
listener at most, 5 kB where all are there, and a group of few listeners among very many costs little. Bitmaps of drops
made apart are merged word by word; the bits set are the distinct listeners, exactly. Rows are dealt to tasks by how many
there are, not by their compressed bytes (which tell little of a bitmap), so a task's memory doesn't grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.operators.kpis import KEYS
from listenkpi.operators.numbering import numbered
from listenkpi.sources.sinks import stage

BUCKET = "bucket"
#: Numbers of a bitmap, and of a word of it.
SPAN, WORD = 32_768, 64
#: Listens (bitmaps) that a task gathers on average.
TASK_LISTENS, TASK_BITMAPS = 250_000, 16_384


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def number_listeners(listens: DataFrame, path: str) -> DataFrame:
    """``user_id, number`` of all listeners seen so far: those of ``listens`` that the table at ``path`` lacks are
    added with the next numbers. Doing it again adds nothing. One writer at a time."""
    spark = listens.sparkSession
    users = listens.select("user_id").where("user_id IS NOT NULL").distinct()
    last = 0
    if _exists(spark, path):
        known = spark.read.parquet(path)
        last = known.agg(F.max("number").alias("n")).first()["n"] or 0
        users = users.join(known, "user_id", "left_anti")
    fresh = stage(numbered(users, "number", last + 1), "listeners")
    fresh.write.mode("append").parquet(path)
    return spark.read.schema(fresh.schema).parquet(path)


def _gathered(words: DataFrame) -> DataFrame:
    """Bitmaps of ``KEYS, bucket, word, bits``, which lie together by ``KEYS, bucket``."""
    whole = words.groupBy(*KEYS, BUCKET, "word").agg(F.bit_or("bits").alias("bits"))
    held = whole.groupBy(*KEYS, BUCKET).agg(F.collect_list(F.struct("word", "bits")).alias("held"))
    return held.select(*KEYS, BUCKET, F.struct(F.col("held.word").alias("words"), F.col("held.bits").alias("bits")).alias("listeners"))


def listener_bitmaps(listens: DataFrame, numbers: DataFrame) -> DataFrame:
    """``date, track_genre, bucket, listeners``: the listeners of each group as bitmaps. ``listens`` is a stored table
    (its rows are counted)."""
    parts = 1 + listens.count() // TASK_LISTENS
    own = listens.select(*KEYS, "user_id").distinct().join(numbers, "user_id")
    told = own.select(*KEYS, F.expr(f"(number - 1) div {SPAN}").alias(BUCKET), F.expr(f"(number - 1) % {SPAN} div {WORD}").cast("smallint").alias("word"),
                      F.expr(f"shiftleft(1L, cast((number - 1) % {WORD} as int))").alias("bits"))
    return _gathered(told.repartition(parts, *KEYS, BUCKET))


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several drops as one for each group and bucket. ``bitmaps`` is read from stored tables (its rows are counted)."""
    rows = bitmaps.repartition(1 + bitmaps.count() // TASK_BITMAPS, *KEYS, BUCKET)
    return _gathered(rows.select(*KEYS, BUCKET, F.inline(F.arrays_zip(F.col("listeners.words").alias("word"), F.col("listeners.bits").alias("bits")))))


def count_listeners(merged: DataFrame) -> DataFrame:
    """``date, track_genre, unique_listeners`` from merged bitmaps."""
    own = F.aggregate("listeners.bits", F.lit(0).cast("bigint"), lambda n, word: n + F.bit_count(word))
    return merged.groupBy(*KEYS).agg(F.sum(own).alias("unique_listeners"))
