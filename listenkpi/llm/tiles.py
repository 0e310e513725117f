"""A stated query set against all rows, in tiles of bounded size.

Rows are packed into blocks (one table row holds the numbers of up to ``BLOCK`` vectors), inside the tasks
that read them. Blocks are dealt by their position, not by a value, into stripes; queries are dealt by a hash of their id into
groups of about ``GROUP`` rows. A tile is one group against one stripe: each group goes to every stripe and
each stripe to every group, so a task holds one group and one block at a time, whatever the vectors are and
however many rows share a value. Tiles only pass on what they keep of each query (its best few).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.llm.common import write_table

BLOCK = 4096  # vectors of a block
GROUP = 8192  # queries of a group, about
STRIPE = 64  # blocks of a stripe, at most about
BATCH_BYTES = 16 << 20
BLOCKS = "part bigint, ids binary, side binary, vecs binary"


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches bounded by bytes while a table of packed rows is written; the setting is put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def finite(vec: str) -> Column:
    """Whether the vector is there, has components, and none of them is NULL or not finite."""
    x = F.col(vec)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & F.coalesce(~odd, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as rows of a matrix of doubles; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float), np.asarray(column.value_lengths())
    if len(ends) and (ends == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(ends), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)
    out[np.repeat(np.arange(len(ends)), ends), at] = flat
    return out


def packed(rows: DataFrame, width: int, part: Callable[[int, int], int] | None, side: Callable[[pa.RecordBatch], np.ndarray],
           block: int = BLOCK, kind: str = "<f8") -> DataFrame:
    """Blocks of ``rows`` (``id bigint, vec array``, the columns ``side`` reads and, without the function
    ``part``, the number ``part``). ``part`` gives a block its number from its task and place in it; without
    it a block holds rows of one ``part``. Inside a block ids ascend."""

    def told(number: int, ids: np.ndarray, extra: np.ndarray, vecs: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        cells = [ids[order].astype("<i8"), extra[order], vecs[order].astype(kind)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
                                          names=["part", "ids", "side", "vecs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int | None, list[tuple]] = {}
        task, made = TaskContext.get().partitionId(), 0

        def flush(key: int | None, rest: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made
            parts = [np.concatenate(c) for c in zip(*held.pop(key), strict=True)]
            lo = 0
            while len(parts[0]) - lo >= block or rest and lo < len(parts[0]):
                yield told(part(task, made) if part else key, *[c[lo:lo + block] for c in parts])
                lo, made = lo + block, made + 1
            if lo < len(parts[0]):
                held[key] = [tuple(c[lo:] for c in parts)]

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, extra, vecs = np.asarray(batch.column("id")), side(batch), matrix(batch.column("vec"), width)
            keys = np.zeros(len(ids), np.int64) if part else np.asarray(batch.column("part"))
            for key in np.unique(keys).tolist():
                own = np.flatnonzero(keys == key)
                name = None if part else key
                held.setdefault(name, []).append((ids[own], extra[own], vecs[own]))
                if sum(len(h[0]) for h in held[name]) >= block:
                    yield from flush(name, False)
        for key in list(held):
            yield from flush(key, True)

    return rows.mapInArrow(run, BLOCKS)


def tiled(rows: DataFrame, queries: DataFrame, width: int, side: Callable, n_rows: int, n_queries: int,
          block: int = BLOCK, group: int = GROUP) -> tuple[DataFrame, int]:
    """The tiles' blocks, ready for ``scan``, and their number: rows ``tile, kind, ids, side, vecs`` (kind 0:
    queries). ``rows`` and ``queries`` hold ``id, vec`` and what ``side`` reads. The blocks are a written table."""
    spark = rows.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, blocks = max(1, -(-n_queries // group)), max(1, -(-n_rows // block))
    stripes = min(blocks, max(-(-blocks // STRIPE), -(-wide // groups)))
    with small_batches(spark):
        stored, _ = write_table(packed(rows, width, lambda task, k: (task + k) % stripes, side, block), "blocks")
        asked = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("bigint"))
        asked, _ = write_table(packed(asked, width, None, side, group), "questions")
    cells = ["ids", "side", "vecs"]
    own = F.col("part") * stripes  # a group's first tile
    asked = asked.select(F.explode(F.sequence(own, own + stripes - 1)).alias("tile"), F.lit(0).alias("kind"), *cells)
    last = F.col("part") + (groups - 1) * stripes  # a stripe's last tile
    stored = stored.select(F.explode(F.sequence(F.col("part"), last, F.lit(stripes).cast("bigint"))).alias("tile"), F.lit(1).alias("kind"), *cells)
    return asked.unionByName(stored), groups * stripes


def scan(tiles: DataFrame, number: int, start: Callable[[list[tuple]], object], schema: str) -> DataFrame:
    """For each tile ``start`` makes a state from the queries' blocks (``ids, side, vecs`` as bytes); the state
    takes each block by ``add`` and yields record batches of ``schema`` by ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, questions, state = None, [], None

        def end() -> Iterator[pa.RecordBatch]:
            if state is not None:
                yield from state.rows()

        for batch in batches:
            tile, kind = batch.column("tile").to_pylist(), batch.column("kind").to_pylist()
            for i in range(batch.num_rows):
                if tile[i] != now:
                    yield from end()
                    now, questions, state = tile[i], [], None
                cells = tuple(batch.column(c)[i].as_py() for c in ("ids", "side", "vecs"))
                if kind[i] == 0:
                    questions.append(cells)
                elif questions:  # a group may be empty
                    if state is None:
                        state = start(questions)
                    state.add(*cells)
        yield from end()

    # a partition a tile; of very many tiles some share one and come one after the other
    parts = min(number, 100_000)
    dealt = tiles.repartitionById(parts, F.pmod(F.col("tile"), F.lit(parts)).cast("int")).sortWithinPartitions("tile", "kind")
    spark = tiles.sparkSession
    with small_batches(spark):
        kept, _ = write_table(dealt.mapInArrow(run, schema), "kept")
    return kept
