"""Data-quality operators: NULL profile, fill, whole-row distinct, NULL drop, required columns.

Cleaning rules of the daily job, in the job's order (the order changes results):

* songs: NULL strings become ``Unknown`` first, then exact copies go, then rows with any NULL left
  (a numeric NULL such as a missing duration) go. A song without a duration therefore vanishes.
* plays and users: exact copies go, rows with any NULL go.

``dropna`` is a row filter and commutes with the whole-row distinct, so it runs first: rows are
discarded before the distinct's shuffle instead of after it. The distinct is planned by Spark as a
partial (map-side) aggregate, an exchange and a final aggregate, so a group of exact copies, however
large, is collapsed inside each map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.functions.columns import is_null_count
from listenkpi.schemas import FILL_VALUE, REQUIRED
from listenkpi.sources.sinks import stage


def null_profile(df: DataFrame) -> DataFrame:
    """One row, one NULL count per column (one pass over the table)."""
    return df.select(*[is_null_count(c) for c in df.columns])


def null_profile_long(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, column, null_count)`` for several tables; one pass over each table."""
    parts = []
    for name, df in tables.items():
        wide = null_profile(df)
        parts.append(
            wide.unpivot([], wide.columns, "column", "null_count").select(
                F.lit(name).alias("table"), "column", F.col("null_count").cast(T.LongType()).alias("null_count")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its NULL profile: filled by whatever action runs over ``df`` first, so the profile
    costs no pass of its own."""
    seen = Observation()
    return df.observe(seen, *[is_null_count(c) for c in df.columns]), seen


def stage_clean(tables: Mapping[str, DataFrame], clean: Mapping[str, Callable[[DataFrame], DataFrame]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each table cleaned and staged, and ``table, column, loaded, cleaned``: its NULL counts before and after the
    cleaning, both observed by the write itself (one scan of each table)."""
    out, rows = {}, []
    for name, df in tables.items():
        raw, before = observed(df)
        done, after = observed(clean[name](raw))
        out[name] = stage(done, f"clean-{name}")
        rows += [(name, c, int(before.get[c]), int(after.get[c])) for c in df.columns]
    spark = next(iter(tables.values())).sparkSession
    return out, spark.createDataFrame(rows, "table string, column string, loaded bigint, cleaned bigint")


def fill_unknown(df: DataFrame, value: str = FILL_VALUE) -> DataFrame:
    """NULL strings -> ``value``; other types untouched (``na.fill`` with a string)."""
    return df.na.fill(value)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct over every column (extra columns included)."""
    return df.dropDuplicates()


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column. An empty string is a value and stays."""
    return df.dropna()


def clean_plays(plays: DataFrame) -> DataFrame:
    """Plays as the daily job uses them: complete rows, each distinct row once."""
    return distinct_rows(drop_incomplete(plays))


def clean_users(users: DataFrame) -> DataFrame:
    return distinct_rows(drop_incomplete(users))


def clean_songs(songs: DataFrame, value: str = FILL_VALUE) -> DataFrame:
    """Fill NULL strings, then drop rows with a NULL left, then keep each distinct row once."""
    return distinct_rows(drop_incomplete(fill_unknown(songs, value)))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns absent from ``df`` (exact, case-sensitive names; schema only, no scan)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def column_report(spark: SparkSession, tables: Mapping[str, DataFrame],
                  required: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``(table, column, present)`` for every required column of every table (schema only)."""
    required = required or REQUIRED
    rows = [
        (name, c, c in set(df.columns))
        for name, df in tables.items()
        for c in required[name]
    ]
    schema = "table string, column string, present boolean"
    return spark.createDataFrame(rows, schema)


def validate(tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]] | None = None) -> None:
    """Gate: raise ``ValueError`` naming every table with a missing column; return when all pass."""
    required = required or REQUIRED
    problems = {name: missing_columns(df, required[name]) for name, df in tables.items()}
    problems = {k: v for k, v in problems.items() if v}
    if problems:
        raise ValueError(f"Missing columns: {problems}")
