"""Ordered export: CSV files that are in total order one after the other, each row with its number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenkpi.operators.numbering import numbered
from listenkpi.sources.sinks import write_csv


#: Stands for NULL in the files, so that an empty text is told from it.
NULL = "\\N"


def write_ordered_csv(df: DataFrame, path: str, order: Sequence[Column], parts: int | None = None, number: str = "row") -> str:
    """Write ``df`` in the total order of ``order`` as up to ``parts`` CSV files (by default the shuffle partitions) whose
    names sort as their rows do, NULL as ``NULL`` has it; ``number`` counts the rows through all files from 1. Rows are dealt by range, each
    range is sorted by itself, and its first number is the rows of the ranges before: no task sees the whole table."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = numbered(ranges, number, part="_part")
    return write_csv(rows.repartitionById(n, F.col("_part").cast("int")).sortWithinPartitions(number).drop("_part"), path, null=NULL)
