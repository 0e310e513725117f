"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints, exact pairs, components.

A pair within ``max_bits`` (D) differing bits differs in at most one bit in at least one of ``D // 2 + 1``
equal blocks of the fingerprint. Each block has a vantage-point tree of search radius 1. A node measures
the Hamming distance between its vantage point and the fingerprint on one segment of the block and branches
by that distance (the ring); the child's vantage point depends on the ring. So a fingerprint's leaf (its
shard) is its path of rings. The segments are disjoint, and by the triangle inequality a difference of one
bit moves a fingerprint by one ring on one level at most. A search of radius 1 therefore prunes every branch
but its own and those one ring away on one level, below which it goes on by that branch's own vantage points:
a fingerprint is stored in one shard, and asks its own and each neighbouring shard one ring further out (the
pair across an edge is found from its inner side). Candidates that meet in a shard are checked on all 64
bits, so the pairs are exact: none is lost.

Trees deepen with the data: segments begin ``SEGMENT_BITS`` wide, and the widest are halved, down to single
bits, until a fingerprint is expected to meet at most ``MEETS`` others. What it meets is reckoned from the counted
fingerprints and a bounded sample (``SAMPLE``, the first by hash), as are the vantage points, picked for even
rings; both affect the sizes of the shards, never the result. Every fingerprint is indexed.

Equal fingerprints are one vertex, so copies are never paired with each other: a group of copies that
holds a third of all rows is one row of the index. A fingerprint has at most C(64,1) + C(64,2) others
within two bits, so the links grow with the distinct fingerprints. Components are found by passing the
least label along the links and jumping to the label's label, each round a written table.

Defined results: NULL and empty texts, and texts without words, have fingerprint zero, linked like any
other. Repeated rows each get a row. A row without doc_id gets its group's least id; a group without any
id has component_id NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenkpi.llm.common import by_slices, drop_table, id_text, write_table

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SAMPLE = 4096
SEGMENT_BITS = 4
MEETS = 16


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every ``width``-word shingle of the text, A-Z lower-cased; words end at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64)


def fingerprints(texts: list[str], width: int = SHINGLE) -> np.ndarray:
    """One 64-bit fingerprint for each text: a bit is 1 if it is 1 in over half the shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    hashes = [shingle_hashes(t, width) for t in texts]
    sizes = np.array([len(h) for h in hashes])
    have = np.flatnonzero(sizes)
    if not len(have):
        return out
    counts = np.zeros((len(have), 64), np.int64)
    step = 1 << 16  # hashes whose bits are unpacked at once
    flat, ends = np.concatenate([hashes[i] for i in have]), np.cumsum(sizes[have])
    starts = ends - sizes[have]
    for lo in range(0, len(flat), step):
        hi = min(lo + step, len(flat))
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
        bits = np.unpackbits(flat[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[a:b] += np.add.reduceat(bits, np.maximum(starts[a:b] - lo, 0), axis=0, dtype=np.int64)
    set_bits = counts * 2 > sizes[have][:, None]
    out[have] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id bigint, fp bigint`` for each row of ``doc_id, text``; a further column ``digest`` stays."""
    more = ["digest"] if "digest" in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_slices(batches, "text"):
            fps = fingerprints(texts, width).view(np.int64)
            cells = [batch.column("doc_id"), pa.array(fps, pa.int64()), *[batch.column(c) for c in more]]
            yield pa.RecordBatch.from_arrays(cells, names=["doc_id", "fp", *more])

    return docs.mapInArrow(run, ", ".join(["doc_id bigint", "fp bigint", *[f"{c} string" for c in more]]))


class Tree:
    """A vantage-point tree of search radius 1 over the bits ``lo`` to ``hi``. ``levels``: (first bit, width) of each
    level's segment; ``points[level][ring above]``: the vantage points."""

    def __init__(self, lo: int, hi: int, sample: np.ndarray, n: int):
        self.levels = [(s, min(SEGMENT_BITS, hi - s)) for s in range(lo, hi, SEGMENT_BITS)]
        while True:
            self._plant(sample)
            widest = max(range(len(self.levels)), key=lambda i: self.levels[i][1])
            s, width = self.levels[widest]
            if width == 1 or self._meets(sample, n) <= MEETS:
                return
            self.levels[widest:widest + 1] = [(s, width // 2), (s + width // 2, width - width // 2)]

    def _plant(self, sample: np.ndarray) -> None:
        """For each level and ring above it the segment value, among the sample's there, whose rings are the most even."""
        self.points, above = [], np.zeros(len(sample), np.int64)
        for i, (s, width) in enumerate(self.levels):
            part = _segment(sample, s, width)
            own = np.zeros(self.levels[i - 1][1] + 1 if i else 1, np.uint64)
            for ring in range(len(own)):
                here = part[above == ring] if (above == ring).any() else part
                if len(here):
                    own[ring] = min(np.unique(here), key=lambda v: int((np.bincount(np.bitwise_count(here ^ v)).astype(np.int64) ** 2).sum()))
            self.points.append(own)
            above = np.bitwise_count(part ^ own[above]).astype(np.int64)

    def _meets(self, sample: np.ndarray, n: int) -> float:
        """How many others of ``n`` fingerprints one is expected to meet in the shards that it asks."""
        if len(sample) < 2:
            return 0.0
        rings = self.rings(sample)
        alike = lambda key: (np.unique(key, return_counts=True)[1] / len(key)) ** 2
        apart = np.prod([alike(r).sum() for r in rings])  # as if levels were independent
        counts = np.unique(self.shards(rings), return_counts=True)[1]
        seen = (counts * (counts - 1.0)).sum() / (len(sample) * (len(sample) - 1.0))  # pairs of the sample that meet
        return n * max(float(apart), seen) * (1 + sum(float((r < w).mean()) for r, (_, w) in zip(rings, self.levels, strict=True)))

    def rings(self, fps: np.ndarray, told: list[np.ndarray] = ()) -> list[np.ndarray]:
        """The path's rings; those in ``told`` are given, the rest measured below them."""
        out = list(told)
        for i in range(len(out), len(self.levels)):
            at = self.points[i][out[i - 1]] if i else self.points[i][0]
            out.append(np.bitwise_count(_segment(fps, *self.levels[i]) ^ at).astype(np.int64))
        return out

    def shards(self, rings: list[np.ndarray]) -> np.ndarray:
        """The number of the path. Numbers of very long paths wrap: two paths may share one, which costs a check of bits only."""
        out = np.zeros(len(rings[0]), np.uint64)
        for ring, (_, width) in zip(rings, self.levels, strict=True):
            out = out * np.uint64(width + 1) + ring.astype(np.uint64)
        return out

    def asked(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each level, which fingerprints ask the branch one ring further out, and the shards below it."""
        rings = self.rings(fps)
        for i, (_, width) in enumerate(self.levels):
            inner = np.flatnonzero(rings[i] < width)
            further = self.rings(fps[inner], [*[r[inner] for r in rings[:i]], rings[i][inner] + 1])
            yield inner, self.shards(further)


def _segment(fps: np.ndarray, s: int, width: int) -> np.ndarray:
    return (fps >> np.uint64(s)) & np.uint64((1 << width) - 1)


def plant(fps: DataFrame, max_bits: int) -> list[Tree]:
    """The trees of ``fps`` (one column ``fp``, distinct values); together they cover the 64 bits."""
    first = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r["fp"] for r in first], np.int64).view(np.uint64)
    many = fps.count() if len(sample) == SAMPLE else len(sample)
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [Tree(lo, hi, sample, many) for lo, hi in zip(edges, edges[1:], strict=False)]


def meetings(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: fingerprints of ``fps`` that meet in a shard, each two once a tree at most."""
    trees = plant(fps, max_bits)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column("fp")).view(np.uint64)
            for t, tree in enumerate(trees):
                yield rows(fp, tree.shards(tree.rings(fp)), t, True, ["b", "shard", "tree"])

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "shard", "tree", "own"]
        for batch in batches:
            fp = np.asarray(batch.column("fp")).view(np.uint64)
            for t, tree in enumerate(trees):
                yield rows(fp, tree.shards(tree.rings(fp)), t, True, names)
                for inner, shard in tree.asked(fp):
                    yield rows(fp[inner], shard, t, False, names)

    def rows(fp: np.ndarray, shard: np.ndarray, t: int, own: bool, names: list[str]) -> pa.RecordBatch:
        cells = [pa.array(fp.view(np.int64)), pa.array(shard.view(np.int64)), pa.array(np.full(len(fp), t, np.int32)), pa.array(np.full(len(fp), own))]
        return pa.RecordBatch.from_arrays(cells[:len(names)], names=names)

    index = fps.select("fp").mapInArrow(stored, "b bigint, shard bigint, tree int")
    asked = fps.select("fp").mapInArrow(asks, "a bigint, shard bigint, tree int, own boolean")
    return asked.join(index, ["shard", "tree"]).where(~F.col("own") | (F.col("a") < F.col("b"))).select("a", "b")


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a bigint, b bigint``: all pairs of different fingerprints of ``fps`` (one column ``fp``, distinct
    values) that differ in at most ``max_bits`` bits. A pair may come once from each tree."""
    return meetings(fps, max_bits).where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) & (F.col("a") != F.col("b")))


def components(links: DataFrame) -> DataFrame:
    """``v, label``: every vertex of ``links`` (``a, b``) with the least vertex of its component. Each
    round is a written table; rounds grow with the logarithm of the longest chain of links."""
    spark = links.sparkSession
    both, edges_at = write_table(links.select(F.col("a").alias("v"), F.col("b").alias("u"))
                                 .unionByName(links.select(F.col("b").alias("v"), F.col("a").alias("u"))).distinct(), "links")
    labels, at = write_table(both.groupBy("v").agg(F.least("v", F.min("u")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        hooked, hooked_at = write_table(labels.join(around, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        roots = hooked.select(F.col("v").alias("label"), F.col("label").alias("root"))
        jumped, next_at = write_table(hooked.join(roots, "label").select("v", "old", F.col("root").alias("label")), "labels")
        drop_table(spark, at)
        drop_table(spark, hooked_at)
        changed = not jumped.where("old != label").isEmpty()
        labels, at = jumped.select("v", "label"), next_at
        if not changed:
            drop_table(spark, edges_at)
            return labels


def grouped(own: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``own`` (a written table with ``doc_id, fp``) with ``component_id``, the least doc_id reachable, and ``group``, a
    number that no other component has (one doc_id may be the least of several, where it names several texts)."""
    reps, _ = write_table(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "vertices")
    label = components(near_pairs(reps.select("fp"), max_bits)).select(F.col("v").alias("fp"), "label")
    linked, _ = write_table(label.join(reps, "fp"), "linked")
    roots = linked.groupBy("label").agg(F.min("least").alias("reached"))
    ids, _ = write_table(reps.join(linked.join(roots, "label").select("fp", "reached", "label"), "fp", "left")
                         .select("fp", F.coalesce("reached", "least").alias("component_id"), F.coalesce("label", "fp").alias("group")), "components")
    return own.join(ids, "fp", "left").select(*own.columns, "component_id", "group")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs`` (``doc_id``, ``text``): the fingerprint, and the
    least doc_id reachable by links of at most ``max_bits`` bits."""
    own, _ = write_table(with_fingerprints(id_text(docs), shingle), "fingerprints")
    return grouped(own, max_bits).drop("group")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the least doc_id; columns as they
    were. Rows are told apart by doc_id and text: where one doc_id names different texts, each is judged by
    its own group, and of a group's rows of the least doc_id the one with the least digest stays. Of rows that repeat
    a kept doc_id and text one stays. Rows without doc_id stay, as nothing names them."""
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    own, _ = write_table(with_fingerprints(id_text(docs).withColumn("digest", digest), shingle), "fingerprints")
    groups = grouped(own, max_bits).where("doc_id IS NOT NULL")
    # only rows of a group's least id can stay: a group's other rows needn't meet
    first = groups.where("doc_id = component_id").groupBy("group", "doc_id").agg(F.min("digest").alias("digest"))
    first = first.select("doc_id", "digest", F.lit(True).alias("first"))
    judged = groups.groupBy("doc_id", "digest").count().join(first, ["doc_id", "digest"], "left")
    judged, _ = write_table(judged.select("doc_id", "digest", "count", F.coalesce("first", F.lit(False)).alias("stays")), "judged")
    key, mark = "gone_id", "gone_digest"
    while key in docs.columns or mark in docs.columns:
        key, mark = f"{key}_", f"{mark}_"
    named = lambda rows: rows.select(F.col("doc_id").alias(key), F.col("digest").alias(mark))
    same = (F.col("doc_id").cast("bigint") == F.col(key)) & (digest == F.col(mark))
    kept = docs.join(named(judged.where("NOT stays")), same, "left_anti")
    again = judged.where("stays AND count > 1")
    if again.isEmpty():
        return kept
    of_text = kept.withColumn(mark, digest)
    once = of_text.join(named(again).withColumnRenamed(mark, f"{mark}_"), (F.col("doc_id").cast("bigint") == F.col(key)) & (F.col(mark) == F.col(f"{mark}_")), "left_semi")
    return kept.join(named(again), same, "left_anti").unionByName(once.dropDuplicates(["doc_id", mark]).drop(mark))
