"""Shared helpers: scratch tables, input shaping, batch slicing, held-out folds, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.session import delete_path, scratch_path

#: Text bytes that numpy works on at once inside a task; one longer text is worked on alone.
SLICE_BYTES = 1 << 20


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the application's scratch folder and read it back: lineage ends here, and a
    lost executor means a re-read. Returns the table and its path (for ``drop_table``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose readers have all been written."""
    delete_path(spark, path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id bigint, text string``: further columns, whatever their names, can't clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: str | Column, modulus: int) -> Column:
    """``crc32`` of the id written as text, modulo ``modulus`` (NULL id: NULL)."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col) % modulus


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether the row belongs to the held-out fold; a row without id doesn't (it is never labelled)."""
    return F.coalesce(fold(id_col, modulus) == remainder, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, classes: str, bounds: dict) -> DataFrame:
    """For each class of ``bounds`` at most that many rows, the first by a hash of the id: the same rows
    whatever the partitioning. ``rows`` holds ``key`` and ``classes`` only, so no text moves here."""
    parts = [rows.where(F.col(classes) == F.lit(v)).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(n)
             for v, n in bounds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def by_slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into pieces of bounded text size; a NULL text comes as the empty string."""
    for batch in batches:
        # cut by the offsets first, so that the Python strings of one piece only exist at a time
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.nan_to_num(np.asarray(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), dtype=float))
        lo, size = 0, 0.0
        for i, n in enumerate(sizes):
            if i > lo and size + n > most:
                yield batch.slice(lo, i - lo), [t or "" for t in column.slice(lo, i - lo).to_pylist()]
                lo, size = i, 0.0
            size += n
        if lo < batch.num_rows:
            yield batch.slice(lo), [t or "" for t in column.slice(lo).to_pylist()]
