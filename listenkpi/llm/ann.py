"""Approximate nearest neighbours by randomly rotated one-bit codes.

Largest inner products of a stated query set among all rows:

1. All vectors are centred on the mean of a bounded sample (``SAMPLE`` rows, the first by a hash of their
   id) and rotated by one random orthogonal matrix (a fixed seed). A code holds the sign of each rotated
   component, packed to bits. With ``x`` the code as a unit vector and ``o`` the centred vector, the
   correction scalars are ``f = |o|**2 / sum|o_i|`` and ``e = |o| * sqrt(1 - a*a) / (a * sqrt(width - 1))``
   with ``a = <x, o> / |o|``.
2. ``f * <signs, q>`` is an unbiased estimate of ``<o, q>``, whose error over random rotations is about
   normal with standard deviation ``e * |q|``. A row is reranked, its exact inner product with the query
   taken in doubles, unless its estimate plus ``ERRORS`` such deviations lies under the query's 20th best so far.
3. Queries and rows meet in tiles (``tiles``): each tile keeps the best ``k`` of each query, and a window
   over those few merges the tiles.

Nothing is sampled, capped or probed but for the centre: every row has a code, and every code is compared
with every query. The result is exact but for rows whose error exceeds the bound; measured recall is in the README.

Defined results: vectors that are NULL, empty, all zero, or hold a NULL or non-finite component take no part,
nor do rows without id. Shorter vectors count as if they ended in zeros. Equal scores go by the smaller
vec_id. A row's own id is never its neighbour. Rows that repeat an id with the same or another vector are candidates
each; of repeated query rows one asks, that with the least vector. Fewer candidates than ``k``: all.
An empty table, or one without queries, gives no rows. Clashing further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenkpi.llm import tiles

K = 20
EVERY = 20
ERRORS = 3.0
SAMPLE = 4096
SEED = 11
_QUERIES = 1024  # whose estimates are held at once
_PAIRS = 1 << 18  # reranked at once
RESULT = "query_id bigint, vec_id bigint, score double"


def rotation(width: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, ``width`` rows by that number made up to whole bytes of bits."""
    full = -(-width // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((full, full)))
    return (q * np.sign(np.diag(r)))[:width]


def encode(vecs: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, and the scalars ``f`` and ``e`` of each vector."""
    o = (vecs - centre) @ turn
    norm, one = np.linalg.norm(o, axis=1), np.abs(o).sum(1)
    full = o.shape[1]
    safe = np.where(one > 0, one, 1.0)
    a = np.where(norm > 0, one / np.where(norm > 0, norm, 1.0) / np.sqrt(full), 1.0)
    f = np.where(one > 0, norm * norm / safe, 0.0)
    e = norm * np.sqrt(np.maximum(0.0, 1 - a * a)) / a / np.sqrt(max(1, full - 1))
    return np.packbits(o > 0, axis=1), f, e


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the columns ``i`` of ``a`` with the columns ``j`` of ``b``, summed in order of the
    components. (``a`` and ``b`` hold a component a row.)"""
    out = np.empty(len(i))
    for lo in range(0, len(i), _PAIRS):
        x, y = i[lo:lo + _PAIRS], j[lo:lo + _PAIRS]
        total = np.zeros(len(x))
        for u, v in zip(a, b, strict=True):
            total += u[x] * v[y]
        out[lo:lo + _PAIRS] = total
    return out


class Search:
    """One tile: the queries of a group, and the best ``k`` of each among the blocks seen."""

    def __init__(self, questions: list[tuple], width: int, centre: np.ndarray, turn: np.ndarray, k: int, errors: float):
        self.ids = np.concatenate([np.frombuffer(q[0], "<i8") for q in questions])
        vecs = np.concatenate([np.frombuffer(q[2], "<f8").reshape(-1, width) for q in questions])
        self.width, self.centre, self.turn, self.k, self.errors = width, centre, turn, k, errors
        self.told = np.ascontiguousarray(vecs.T)
        self.turned = (vecs @ turn).astype(np.float32)
        self.norms, self.shift = np.linalg.norm(vecs, axis=1), vecs @ centre
        self.best = np.full((len(self.ids), k), -np.inf)
        self.names = np.full((len(self.ids), k), np.iinfo(np.int64).max)

    def add(self, ids: bytes, side: bytes, vecs: bytes) -> None:
        ids = np.frombuffer(ids, "<i8")
        code, f, e = _unpack(side, len(ids), self.turn.shape[1])
        signs = np.unpackbits(code, axis=1).astype(np.float32) * 2 - 1
        known = np.ascontiguousarray(np.frombuffer(vecs, "<f8").reshape(-1, self.width).T)
        for lo in range(0, len(self.ids), _QUERIES):
            self._block(slice(lo, lo + _QUERIES), ids, signs, f, e, known)

    def _block(self, own: slice, ids: np.ndarray, signs: np.ndarray, f: np.ndarray, e: np.ndarray, known: np.ndarray) -> None:
        k = self.k
        guess = (self.turned[own] @ signs.T) * f.astype(np.float32)
        bound = guess + (self.errors * self.norms[own]).astype(np.float32)[:, None] * e.astype(np.float32)
        bound += 1e-5 * np.abs(guess) + 1e-12  # of the floats themselves
        short = np.flatnonzero(self.best[own, k - 1] == -np.inf)
        if len(short):  # no threshold yet: the best guesses make one
            n = min(2 * k, len(ids))
            top = np.argpartition(-guess[short], n - 1, axis=1)[:, :n]
            seeds = np.stack([np.repeat(short, n), top.ravel()], 1)
            bound[seeds[:, 0], seeds[:, 1]] = np.nan  # taken here, not again
            self._take(own, seeds[:, 0], seeds[:, 1], ids, known)
        i, j = np.nonzero(bound >= (self.best[own, k - 1] - self.shift[own])[:, None])
        self._take(own, i, j, ids, known)

    def _take(self, own: slice, i: np.ndarray, j: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """Rerank the pairs and merge them with what the queries have."""
        apart = self.ids[own][i] != ids[j]
        i, j = i[apart], j[apart]
        score = exact(self.told[:, own], known, i, j)
        better = score >= self.best[own][i, self.k - 1]
        i, j, score = i[better], j[better], score[better]
        rows, k = np.unique(i), self.k
        if not len(rows):
            return
        at = np.concatenate([np.repeat(rows, k), i])
        value = np.concatenate([self.best[own][rows].ravel(), score])
        name = np.concatenate([self.names[own][rows].ravel(), ids[j]])
        order = np.lexsort((name, -value, at))
        at, value, name = at[order], value[order], name[order]
        first = np.searchsorted(at, rows)[:, None] + np.arange(k)
        self.best[own.start + rows], self.names[own.start + rows] = value[first], name[first]

    def rows(self) -> Iterator[pa.RecordBatch]:
        i, j = np.nonzero(self.best > -np.inf)
        step = 1 << 16
        for lo in range(0, len(i), step):
            x, y = i[lo:lo + step], j[lo:lo + step]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[x]), pa.array(self.names[x, y]), pa.array(self.best[x, y])],
                                             names=["query_id", "vec_id", "score"])


def _pack(code: np.ndarray, f: np.ndarray, e: np.ndarray) -> np.ndarray:
    return np.concatenate([code, f.astype("<f8").view(np.uint8).reshape(-1, 8), e.astype("<f8").view(np.uint8).reshape(-1, 8)], 1)


def _unpack(side: bytes, n: int, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells = np.frombuffer(side, np.uint8).reshape(n, full // 8 + 16)
    f, e = (np.ascontiguousarray(cells[:, full // 8 + at:full // 8 + at + 8]).view("<f8").ravel() for at in (0, 8))
    return cells[:, :full // 8], f, e


def nearest(vectors: DataFrame, is_query: Column | None = None, k: int = K, errors: float = ERRORS, id_col: str = "vec_id",
            vec_col: str = "embedding", seed: int = SEED, block: int = tiles.BLOCK, group: int = tiles.GROUP) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row (``is_query``, a condition on ``id`` and ``vec``; by
    default each ``EVERY``-th id) its ``k`` rows of the largest inner product."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & tiles.finite("vec")).where(F.exists("vec", lambda v: v != 0))
    asks = is_query if is_query is not None else F.pmod(F.col("id"), F.lit(EVERY)) == 0
    queries = rows.where(asks).groupBy("id").agg(F.min("vec").alias("vec"))
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width"), F.count_if(asks).alias("asked")).first()
    if not told["asked"]:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = told["width"]
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
    centre, turn = tiles.matrix(sample["vec"], width).mean(0), rotation(width, seed)

    def side(batch: pa.RecordBatch) -> np.ndarray:
        return _pack(*encode(tiles.matrix(batch.column("vec"), width), centre, turn))

    dealt, number = tiles.tiled(rows, queries, width, side, told["n"], told["asked"], block, group)
    kept = tiles.scan(dealt, number, lambda questions: Search(questions, width, centre, turn, k, errors), RESULT)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
