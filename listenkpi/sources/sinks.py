"""Sinks: CSV folders, staged Parquet tables, and the keyed KPI table.

* ``write_csv``: header, multi-part output (one file per task; never funnelled into one task).
* ``stage``: write a DataFrame as Parquet in the application's scratch folder and read it back. Used to
  cut lineage where one expensive intermediate feeds several branches: every branch then reads the
  stored table (with column pruning) instead of recomputing it, and a lost executor costs a re-read,
  not a recompute from the raw input.
* ``keyed_upsert``: the KPI table, a ``MonthTable`` with keys: rows whose key is put are replaced, other
  rows stay. Keyed by date it replaces whole days, the unit the job recomputes (the top-genre list is per
  date); keyed by date and genre it replaces items, as a key-value sink does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.session import scratch_path, scratch_scope
from listenkpi.sources.months import MonthTable, month_of


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null: str = "") -> str:
    """Write ``df`` as CSV with a header row; quotes and embedded newlines are escaped. ``null`` stands for NULL: where
    empty texts must be told from it, not the empty string."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("nullValue", null).csv(path)
    return path


def write_lines(lines: DataFrame, path: str, header: str) -> str:
    """Write ready CSV lines (one text column) under a header line in each file."""
    (name,) = lines.columns
    rows = lines.withColumnRenamed(name, header)
    # quoting is off: a line is one cell, written as it is
    rows.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("quote", "\u0000").option("emptyValue", "").csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def stage(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Materialize ``df`` as Parquet in a fresh scratch folder; return the read-back."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_tables(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Staged copy of cleaned tables (one Parquet folder per table, overwritten each run)."""
    out = {}
    for name, df in tables.items():
        out[name] = write_parquet(df, f"{root.rstrip('/')}/{name}")
    return out


def null_safe_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all ``keys``, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def keyed_upsert(df: DataFrame, path: str, keys: Sequence[str] = ("date",), replaced: DataFrame | None = None,
                 months: Sequence[str] | None = None) -> str:
    """Put ``df`` into the keyed table at ``path``: stored rows with a key of ``df`` (NULL is a key like any
    other) are replaced, others stay. ``keys`` begins with ``date``.

    ``replaced``: the keys whose stored rows go, where the caller knows them: those of ``df``, and any for
    which it has no row (a date recomputed to nothing). ``df`` is then computed once, in the write itself.
    ``months``: the months of the keys put, where the caller knows them too; otherwise they are found by a job.
    Only the months of the change are read and written; the driver sees their names, no dates. One writer at
    a time (see ``MonthTable``)."""
    if not keys or keys[0] != "date":
        raise ValueError("keys must begin with 'date', which the table is stored by")
    spark, keys = df.sparkSession, list(keys)
    table = MonthTable(spark, path)
    with scratch_scope(spark):
        new = df if replaced is not None else stage(df, "upsert-new", spark)  # read for its keys and for the merge
        put = (new if replaced is None else replaced).select(*keys).distinct()
        touched = list(months) if months is not None else [
            r["m"] for r in put.select(month_of(F.col("date")).alias("m")).distinct().collect()]
        merged = new
        if table.commit()["schema"] is not None:
            old = table.read(touched)
            merged = old.join(put, null_safe_equal(old, put, keys), "left_anti").unionByName(new, allowMissingColumns=True)
        table.replace(merged, "date", touched)
    return path


def read_keyed(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read the keyed table back, columns in the given order."""
    df = MonthTable(spark, path).read()
    return df.select(*columns) if columns else df
