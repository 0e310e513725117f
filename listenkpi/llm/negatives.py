"""Hard-negative mining: exact integer inner products by Strassen's multiplication, in tiles.

1. Components become the integers ``floor(256 * x)``; a row's score for an anchor is the integer inner
   product. Anchors and rows meet in tiles (``tiles``); a tile's scores are one product of integer matrices,
   made by Strassen's recursion: both matrices are padded with zeros to even sizes, cut into quarters, and
   seven products of sums take the place of eight. Sums and products of 64-bit integers are exact modulo
   2**64, so the score is exact whenever it fits 64 bits itself. Where it may not, the tile is multiplied
   in Python's integers and the scores end at the bounds of 64 bits.
2. Each tile keeps, for each anchor, a heap of its best ``positives`` rows of the same label. Heaps merge: the
   best few of the tiles' best few are the anchor's positives.
3. A second pass over the tiles keeps, for each anchor and positive, a heap of the best ``negatives`` rows
   of another label whose score lies in the window that the positive's score opens. They merge in the same way.

Heaps are bounded by what is asked for, so no task holds a label's rows or an anchor's candidates.

Defined results: rows whose id, label or vector is NULL or empty, or whose vector holds a NULL or non-finite
component, take no part. Shorter vectors count as if they ended in zeros. Equal scores go by the smaller
vec_id. Rows that repeat an id are candidates each, but not for the anchor of that id; of repeated anchor
rows the one with the least label, then vector, counts. A positive that comes twice has its negatives once each time. An
anchor without positives, or a positive without a row in its window, gives no rows; nor does an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenkpi.llm import tiles

POSITIVES, NEGATIVES = 5, 3
EVERY = 50
SCALE = 256
LOW, HIGH, WHOLE = 50, 95, 100  # the window, in hundredths of the positive's score
LEAF = 32  # a side at which the recursion ends
_ANCHORS = 512  # whose scores are held at once
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_NONE = np.int64(_LEAST)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of integer matrices; 64-bit integers wrap."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    # zero rows and columns make the sizes even
    x = np.zeros((m + m % 2, k + k % 2), a.dtype)
    y = np.zeros((k + k % 2, n + n % 2), b.dtype, order="F")  # its columns are read whole
    x[:m, :k], y[:k, :n] = a, b
    i, j, l = x.shape[0] // 2, x.shape[1] // 2, y.shape[1] // 2
    a11, a12, a21, a22 = x[:i, :j], x[:i, j:], x[i:, :j], x[i:, j:]
    b11, b12, b21, b22 = y[:j, :l], y[:j, l:], y[j:, :l], y[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), p1.dtype)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``, kept within 64 bits; never ``_NONE``."""
    top = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if top(a) * top(b) * a.shape[1] < 1 << 62:
        return strassen(a, b.T)
    wide = strassen(a.astype(object), b.T.astype(object))
    return np.clip(wide, _LEAST + 1, _MOST).astype(np.int64)


def quantised(vecs: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as 64-bit integers; what doesn't fit ends at about 2**62."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vecs * SCALE), -(2.0**62), 2.0**62).astype(np.int64)


class Heaps:
    """``rows`` heaps of at most ``size`` entries: the largest scores, then the smallest ids."""

    def __init__(self, rows: int, size: int):
        self.size = size
        self.score = np.full((rows, size), _NONE)
        self.name = np.full((rows, size), _MOST, np.int64)

    def offer(self, at: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """Merge the best of each row of ``found`` (``_NONE``: not offered) into the heaps ``at``. ``ids`` ascend, so the
        first of equal scores has the smallest."""
        live = np.flatnonzero((found > np.minimum(self.score[at, -1], _MOST - 1)[:, None]).any(1) | (found == self.score[at, -1][:, None]).any(1))
        if not len(live):
            return
        at, found = at[live], found[live]
        score, name, rows = [self.score[at]], [self.name[at]], np.arange(len(at))
        for _ in range(min(self.size, found.shape[1])):
            j = found.argmax(1)
            best = found[rows, j]
            score.append(best[:, None])
            name.append(np.where(best > _NONE, ids[j], _MOST)[:, None])
            found[rows, j] = _NONE
        score, name = np.concatenate(score, 1), np.concatenate(name, 1)
        order = np.lexsort((name, -1 - score), axis=1)[:, :self.size]  # -1 - x turns the order and can't overflow
        self.score[at], self.name[at] = np.take_along_axis(score, order, 1), np.take_along_axis(name, order, 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Heap, score and id of each entry held; and the entry's place."""
        i, j = np.nonzero(self.score > _NONE)
        return i, self.score[i, j], self.name[i, j], j


class _Tile:
    """The anchors of a group; ``keep`` is given their scores block by block."""

    def __init__(self, questions: list[tuple], width: int, wide: int):
        self.width = width
        self.ids = np.concatenate([np.frombuffer(q[0], "<i8") for q in questions])
        side = np.concatenate([np.frombuffer(q[1], "<i8").reshape(-1, wide) for q in questions])
        self.label, self.more = side[:, 0], side[:, 1:]
        self.vecs = np.concatenate([quantised(np.frombuffer(q[2], "<f8").reshape(-1, width)) for q in questions])

    def add(self, ids: bytes, side: bytes, vecs: bytes) -> None:
        ids = np.frombuffer(ids, "<i8")
        label = np.frombuffer(side, "<i8").reshape(len(ids), -1)[:, 0]
        known = quantised(np.frombuffer(vecs, "<f8").reshape(-1, self.width))
        for lo in range(0, len(self.ids), _ANCHORS):
            own = np.arange(lo, min(lo + _ANCHORS, len(self.ids)))
            found = scores(self.vecs[own], known)
            other = self.ids[own][:, None] != ids
            self.keep(own, found, other & (self.label[own][:, None] == label), other & (self.label[own][:, None] != label), ids)


class _Positives(_Tile):
    def __init__(self, questions: list[tuple], width: int, size: int):
        super().__init__(questions, width, 1)
        self.heaps = Heaps(len(self.ids), size)

    def keep(self, own, found, same, apart, ids) -> None:
        self.heaps.offer(own, np.where(same, found, _NONE), ids)

    def rows(self) -> Iterator[pa.RecordBatch]:
        at, score, name, _ = self.heaps.entries()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (self.ids[at], name, score)], names=["anchor_id", "other_id", "score"])


class _Negatives(_Tile):
    """``side`` holds the label and the scores of the anchor's positives (``_NONE``: none)."""

    def __init__(self, questions: list[tuple], width: int, slots: int, size: int):
        super().__init__(questions, width, 1 + slots)
        self.heaps = [Heaps(len(self.ids), size) for _ in range(slots)]

    def keep(self, own, found, same, apart, ids) -> None:
        for slot, heaps in enumerate(self.heaps):
            least, most = _window(self.more[own, slot])
            inside = apart & (found >= least[:, None]) & (found <= most[:, None])
            heaps.offer(own, np.where(inside, found, _NONE), ids)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for slot, heaps in enumerate(self.heaps):
            at, score, name, _ = heaps.entries()
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[at]), pa.array(np.full(len(at), slot, np.int32)), pa.array(name), pa.array(score)],
                                             names=["anchor_id", "slot", "other_id", "score"])


def _window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score with ``LOW * p <= WHOLE * score <= HIGH * p``; an empty window for none."""
    found = [(-(-LOW * p // WHOLE), HIGH * p // WHOLE) if p > _LEAST else (_MOST, _LEAST) for p in positive.tolist()]
    return np.array([a for a, _ in found], np.int64), np.array([b for _, b in found], np.int64)


def _labels(*more: str) -> Callable[[pa.RecordBatch], np.ndarray]:
    """What a tile knows of a row beside its vector: its label, and the numbers ``more``."""
    return lambda batch: np.stack([np.asarray(batch.column(c)).astype("<i8") for c in ("label", *more)], 1)


def _best(kept: DataFrame, keys: list[str], n: int, into: str) -> DataFrame:
    """The tiles' heaps merged: the ``n`` best of each key, numbered from 1."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id"))
    return kept.withColumn(into, place).where(F.col(into) <= n)


def relabelled(label: Column, id_col: Column, every: int = 7, labels: int = 10) -> Column:
    """The label plus 1, modulo ``labels``, where ``every`` divides the id."""
    return F.when(F.pmod(id_col, F.lit(every)) == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label)


def hard_negatives(vectors: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                   block: int = tiles.BLOCK, group: int = tiles.GROUP) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. ``is_anchor``: a condition
    on ``id``, ``label`` and ``vec`` (by default each ``EVERY``-th id); ``label``: the labels, by default the column."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), (F.col("label") if label is None else label).cast("bigint").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & tiles.finite("vec"))
    asks = is_anchor if is_anchor is not None else F.pmod(F.col("id"), F.lit(EVERY)) == 0
    anchors = rows.where(asks).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("a")).select("id", "a.label", "a.vec")
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width"), F.count_if(asks).alias("asked")).first()
    if not told["asked"]:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    width, n, asked = told["width"], told["n"], told["asked"]

    dealt, number = tiles.tiled(rows, anchors, width, _labels(), n, asked, block, group)
    kept = tiles.scan(dealt, number, lambda q: _Positives(q, width, positives), "anchor_id bigint, other_id bigint, score bigint")
    best = _best(kept, ["anchor_id"], positives, "slot").select("anchor_id", (F.col("slot") - 1).cast("int").alias("slot"), F.col("other_id").alias("positive_id"),
                                                                F.col("score").alias("positive_score"))
    best, _ = tiles.write_table(best, "positives")
    slots = [f"slot{i}" for i in range(positives)]
    opened = best.groupBy("anchor_id").agg(*[F.max(F.when(F.col("slot") == i, F.col("positive_score"))).alias(s) for i, s in enumerate(slots)])
    opened = opened.select(F.col("anchor_id").alias("id"), *[F.coalesce(s, F.lit(_LEAST).cast("bigint")).alias(s) for s in slots])
    dealt, number = tiles.tiled(rows.select("*", *[F.lit(0).cast("bigint").alias(s) for s in slots]), anchors.join(opened, "id"), width, _labels(*slots), n, asked, block, group)
    kept = tiles.scan(dealt, number, lambda q: _Negatives(q, width, positives, negatives), "anchor_id bigint, slot int, other_id bigint, score bigint")
    found = _best(kept, ["anchor_id", "slot"], negatives, "rank")
    return found.join(best, ["anchor_id", "slot"]).select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
                                                          F.col("score").alias("negative_score"))
