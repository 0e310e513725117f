"""Row numbers without a window over the whole table: counts of the partitions, and their prefix sums.

Rows are written once with Spark's ``monotonically_increasing_id`` (the partition's number in the high bits, the
row's place in the low ones). A row's number is its place plus the rows of the partitions before; only one
count for each partition comes to the driver. No row moves for it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenkpi.sources.sinks import stage

_BITS = 33  # of the place within a partition


def numbered(df: DataFrame, into: str, start: int = 1, part: str | None = None) -> DataFrame:
    """``df`` with ``into``: dense numbers from ``start`` in the order of its partitions and their rows (after
    ``orderBy`` a total order). ``part`` also gives each row's partition. The rows are a staged table."""
    placed = stage(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    own = F.shiftright("_at", _BITS)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(own.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [start, *accumulate((n for _, n in counts), initial=start)][1:]
    firsts = placed.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before, strict=False)], "_part bigint, _first bigint")
    # one row for each partition that has rows: as many as tasks wrote the table
    joined = placed.withColumn("_part", own).join(F.broadcast(firsts), "_part")
    number = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1))
    return joined.select(*df.columns, number.alias(into), *([F.col("_part").alias(part)] if part else []))
