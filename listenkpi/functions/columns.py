"""Scalar column expressions used by the operators. All built-in, JVM-side, codegen friendly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.schemas import MS_PER_MINUTE, ROUND_DIGITS


def named(name: str) -> Column:
    """The column of exactly this name (``F.col`` reads a dot as a field of a struct)."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_time(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Text or timestamp -> timestamp; text that does not parse gives NULL (ANSI stays on), and so does
    text of a year outside 1 to 9999, which Python and most stores cannot hold.

    ``dtype`` is the input type when known; timestamps pass through untouched so that a
    pre-typed source (Parquet) keeps its values and its predicate pushdown.
    """
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast(T.TimestampType())
    if isinstance(dtype, T.DateType):
        return c.cast(T.TimestampType())
    ts = F.try_to_timestamp(c.cast(T.StringType()))
    return F.when(F.year(ts).between(1, 9999), ts)


def ms_to_minutes(ms: Column) -> Column:
    """Milliseconds -> minutes as double."""
    return ms.cast(T.DoubleType()) / F.lit(MS_PER_MINUTE)


def round2(x: Column) -> Column:
    """Half-up rounding to 2 decimals, as ``F.round`` does on doubles."""
    return F.round(x, ROUND_DIGITS)


def to_long(c: Column | str) -> Column:
    """Text number -> long. Accepts ``12`` and ``12.0`` (a pandas round trip writes the latter) and any
    other text of a whole number in range; anything else (``12.7``, ``1e30``, ``Infinity``) gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c.cast(T.StringType()))
    number = text.try_cast(T.DecimalType(38, 10))
    whole = F.when(number == F.floor(number), number.cast(T.StringType()))
    return F.coalesce(text.try_cast(T.LongType()), F.substring_index(whole, ".", 1).try_cast(T.LongType()))


def null_if_token(c: Column | str, tokens: Iterable[str]) -> Column:
    """NULL where the whole cell equals one of ``tokens``; the value otherwise."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(list(tokens)), c)


def is_null_count(name: str) -> Column:
    """Number of NULLs in a column, named after it (one pass over the table for all columns)."""
    return F.count_if(named(name).isNull()).alias(name)
