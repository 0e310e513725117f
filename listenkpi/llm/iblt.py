"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, and inside a line after words picked by their last bytes
(about one in four; every word of the first ``HEAD`` bytes), so that one edit in a long line changes few paragraphs; a stretch without such a word
is cut after every ``LONGEST`` bytes at the next space. Cuts depend on the text near them only. The k-th
repeat of a paragraph counts as an element of its own.

A paragraph's 64-bit digest goes into three cells, one in each third of the sketch; a cell holds the number
of digests, their sum and the sum of their checks. The sketches of two versions subtract cell by cell:
what both hold cancels. A cell left with one digest gives that digest away; taking it out of its other
cells frees more (peeling), until all differing digests of either side are recovered. If cells remain, the
sketch was too small, and both versions are sketched again four times as large. Sizes go up to where peeling
is all but sure (``LAST`` cells a digest); if it still fails, the digests themselves are compared.

The fingerprint of a text is its sketch at the first size, with its number of paragraphs, in hex. It keeps 16
bits of each cell's count and checks, which tells texts apart; differences are peeled from whole cells, made anew from
the texts. White space of any kind counts the same: texts that differ in a tab for a space have equal fingerprints. The
likeness of two texts is the share of paragraphs they hold in common, ``2 c / (a + b)``, from the recovered
differences; two texts without paragraphs have likeness 1, one without and one with have 0.

All texts of an Arrow slice are sketched, subtracted and peeled together in numpy.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.llm.common import by_slices, id_text

FIRST = 12  # cells of the first size, a multiple of three
GROWTH = 4
LAST = 8
LONGEST = 64
HEAD = 48  # within a text's first bytes every word is a paragraph, so short texts have several
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_M = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.where(_SPACES, 0, np.arange(1, 257)).astype(np.uint64)
_POWERS = np.cumprod(np.full(1 << 12, 0x2545F4914F6CDD1D, np.uint64), dtype=np.uint64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer; another permutation for each salt."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a new paragraph begins, ascending; the texts' own ends are among them."""
    at = np.flatnonzero(_SPACES[data]).astype(np.int64)
    inside = at - ends[np.searchsorted(ends, at, "right") - 1]  # bytes of the text before the space
    tail = np.zeros(len(at), np.uint32)
    for k, p in ((1, 0x85EB), (2, 0xC2B3), (3, 0x27D5)):
        tail += np.where(inside >= k, data[np.maximum(at - k, 0)], 0).astype(np.uint32) * np.uint32(p)
    picked = (data[at] == 10) | (((tail * np.uint32(0x9E3779B1)) >> np.uint32(28)) < 4) | (inside < HEAD)
    mark = np.zeros(len(data) + 1, bool)
    mark[at[picked] + 1] = True
    mark[ends] = True
    cuts = np.flatnonzero(mark)
    for g in np.flatnonzero(np.diff(cuts) > 2 * LONGEST).tolist():
        lo, hi = int(cuts[g]), int(cuts[g + 1])
        spaces = at[np.searchsorted(at, lo):np.searchsorted(at, hi)] + 1
        k = int(np.searchsorted(spaces, lo + LONGEST))
        while k < len(spaces):
            mark[spaces[k]] = True
            k = int(np.searchsorted(spaces, spaces[k] + LONGEST))
    return np.flatnonzero(mark)


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all texts' paragraphs, text by text, and where each text's begin (one more: the end)."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    cuts = _cuts(data, ends)
    starts, sizes = cuts[:-1], np.diff(cuts)
    value = _VALUES[data]  # white space counts as nothing: a paragraph is the same at a line's end
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
    if sizes.max() > len(_POWERS):
        value *= (place // len(_POWERS) + 1).astype(np.uint64)
        place %= len(_POWERS)
    value *= _POWERS[place]
    sums = np.add.reduceat(value, starts)
    full = sums != 0  # white space alone is no paragraph
    own = (np.searchsorted(ends, starts[full], "right") - 1)
    sums = _mix(sums[full], 11)
    # the k-th repeat of a digest within a text is an element of its own
    order = np.lexsort((sums, own))
    same = np.concatenate([[False], (sums[order][1:] == sums[order][:-1]) & (own[order][1:] == own[order][:-1])])
    again = np.flatnonzero(same)
    if len(again):
        run = np.arange(len(order))
        run = run - np.maximum.accumulate(np.where(same, 0, run))
        at = order[again]
        sums[at] = _mix(sums[at] ^ (run[again].astype(np.uint64) * _M), 12)
    return sums, np.searchsorted(own, np.arange(len(texts) + 1))


class Cells:
    """The sketches of several sets side by side, ``thirds[i]`` cells in each third of the i-th."""

    def __init__(self, thirds: np.ndarray):
        self.thirds = thirds.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(3 * self.thirds)])
        n = int(self.base[-1])
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def places(self, keys: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        third = self.thirds[own].astype(np.uint64)
        return [self.base[own] + j * self.thirds[own] + (_mix(keys, j) % third).astype(np.int64) for j in range(3)]

    def add(self, keys: np.ndarray, own: np.ndarray, sign: int | np.ndarray) -> np.ndarray:
        """Add (or take out) digests; returns the cells that changed."""
        flip = np.broadcast_to(np.asarray(sign), keys.shape) < 0
        times = np.where(flip, -1, 1)
        key, check = np.where(flip, -keys, keys), _mix(keys, 7)
        check = np.where(flip, -check, check)
        places = self.places(keys, own)
        for at in places:
            np.add.at(self.count, at, times)
            np.add.at(self.keys, at, key)
            np.add.at(self.checks, at, check)
        return np.concatenate(places)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take out all digests that can be: their values, owners and signs; and the owners left undone."""
        of = np.repeat(np.arange(len(self.thirds)), 3 * self.thirds)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.arange(len(self.count))
        while len(look):
            one = look[np.abs(self.count[look]) == 1]
            minus = self.count[one] < 0
            key = np.where(minus, -self.keys[one], self.keys[one])
            check = np.where(minus, -self.checks[one], self.checks[one])
            pure = check == _mix(key, 7)
            key, minus, own = key[pure], minus[pure], of[one[pure]]
            if not len(key):
                break
            order = np.lexsort((key, own))
            first = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (own[order][1:] != own[order][:-1])])
            pick = order[first]
            key, own, sign = key[pick], own[pick], np.where(minus[pick], -1, 1)
            found.append((key, own, sign))
            look = np.sort(self.add(key, own, -sign))
            look = look[np.concatenate([[True], look[1:] != look[:-1]])]
        left = np.flatnonzero(np.bincount(of[(self.count != 0) | (self.keys != 0) | (self.checks != 0)], minlength=len(self.thirds)))
        if not found:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, left
        return *(np.concatenate(x) for x in zip(*found, strict=True)), left


def _spread(starts: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the digests of the given sets, and the number in ``sets`` that each belongs to."""
    n = starts[sets + 1] - starts[sets]
    own = np.repeat(np.arange(len(sets)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[sets], n), own


def differences(keys: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of sets ``a[i], b[i]`` the digests that only one holds: the recovered digests, their
    pair, and 1 (only in a) or -1 (only in b). Pairs that can't be peeled are sketched again, larger."""
    sizes = np.diff(starts)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo, third = np.arange(len(a)), FIRST // 3
    while len(todo):
        gap = np.abs(sizes[a[todo]] - sizes[b[todo]])
        most = sizes[a[todo]] + sizes[b[todo]]
        # fewer cells than the counts already differ by can't be peeled: such pairs wait for their size
        now = gap <= 3 * third
        pairs = todo[now]
        if len(pairs):
            cells = Cells(np.full(len(pairs), third))
            for sets, sign in ((a[pairs], 1), (b[pairs], -1)):
                at, own = _spread(starts, sets)
                cells.add(keys[at], own, sign)
            key, own, sign, left = cells.peel()
            done = np.ones(len(pairs), bool)
            done[left] = False
            keep = done[own]
            out.append((key[keep], pairs[own[keep]], sign[keep]))
            last = ~done & (3 * third > LAST * most[now])
            for p in pairs[last].tolist():
                x, y = keys[starts[a[p]]:starts[a[p] + 1]], keys[starts[b[p]]:starts[b[p] + 1]]
                for only, s in ((np.setdiff1d(x, y), 1), (np.setdiff1d(y, x), -1)):
                    out.append((only, np.full(len(only), p), np.full(len(only), s)))
            todo = np.sort(np.concatenate([todo[~now], pairs[~done & ~last]]))
        third *= GROWTH
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def likeness(keys: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of digests that the pairs of sets hold in common, from their recovered differences."""
    _, pair, _ = differences(keys, starts, a, b)
    sizes = np.diff(starts)
    total = sizes[a] + sizes[b]
    return np.where(total > 0, 1 - np.bincount(pair, minlength=len(a)) / np.maximum(total, 1), 1.0)


def sketches(keys: np.ndarray, starts: np.ndarray) -> list[str]:
    """The sketch of each set at the first size: its number of digests, then each cell, in hex."""
    n = len(starts) - 1
    cells = Cells(np.full(n, FIRST // 3))
    at, own = _spread(starts, np.arange(n))
    cells.add(keys[at], own, 1)
    rows = np.concatenate([cells.count.astype(">u2").view(np.uint8).reshape(-1, 2), cells.keys.astype(">u8").view(np.uint8).reshape(-1, 8),
                           cells.checks.astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1).reshape(n, -1)
    return [f"{size:08x}{row.tobytes().hex()}" for size, row in zip(np.diff(starts).tolist(), rows, strict=True)]


COMPARED = T.StructType([
    T.StructField("old_sketch", T.StringType()), T.StructField("new_sketch", T.StringType()), T.StructField("likeness", T.DoubleType()),
    T.StructField("removed", T.ArrayType(T.LongType())), T.StructField("added", T.ArrayType(T.LongType()))])


def compare(versions: DataFrame, old: str, new: str, into: str) -> DataFrame:
    """``versions`` with a struct column ``into``: the sketches of the two text columns, their likeness and
    the recovered digests of the paragraphs that only the old or only the new text holds."""
    @F.pandas_udf(COMPARED)
    def run(olds: pd.Series, news: pd.Series) -> pd.DataFrame:
        n = len(olds)
        keys, starts = digests([*(t or "" for t in olds), *(t or "" for t in news)])
        a, b = np.arange(n), np.arange(n, 2 * n)
        told = sketches(keys, starts)
        key, pair, sign = differences(keys, starts, a, b)
        only = {s: [[] for _ in range(n)] for s in (1, -1)}
        for k, p, s in zip(key.view(np.int64).tolist(), pair.tolist(), sign.tolist(), strict=True):
            only[s][p].append(k)
        return pd.DataFrame({"old_sketch": told[:n], "new_sketch": told[n:], "likeness": likeness(keys, starts, a, b),
                             "removed": [sorted(x) for x in only[1]], "added": [sorted(x) for x in only[-1]]})

    return versions.withColumn(into, run(F.col(old).cast("string"), F.col(new).cast("string")))


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_paragraphs bigint")


def _results(ids: list, texts: list[str], firsts: np.ndarray) -> pa.RecordBatch:
    """Results for the texts numbered ``firsts``; the one after each is its next document."""
    own = [texts[i] for i in firsts]
    edited = [t[:len(t) - len(t) // 4] + texts[i + 1][:len(t) // 4] for i, t in zip(firsts, own, strict=True)]
    keys, starts = digests([*texts, *edited])
    told = sketches(keys, starts)
    changed = np.arange(len(texts), len(texts) + len(edited))
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([ids[i] for i in firsts], pa.int64()), "n_chars": pa.array(map(len, own), pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": [told[i] for i in firsts], "edited_fingerprint": told[len(texts):],
        "near_edited": likeness(keys, starts, firsts, changed), "near_next": likeness(keys, starts, firsts, firsts + 1),
        "n_paragraphs": pa.array(np.diff(starts)[firsts], pa.int64()),
    })


PREFIX = 64  # characters by which rows of a hot id are ordered first
_KEYS = 50  # sampled rows of hot ids for each group


def _place_of(edges: np.ndarray, cuts: dict[int, list[tuple]]):
    """A column function: a row's group. ``cuts``: for each hot id the (prefix, digest) where its further groups begin; rows
    equal to several cuts are alike and may stand in any of the groups between them."""
    wide = max(map(len, cuts.values()), default=0) + 2

    @F.pandas_udf(T.LongType())
    def place(k: pd.Series, prefix: pd.Series, digest: pd.Series, tie: pd.Series) -> pd.Series:
        ids = k.to_numpy()
        found = np.searchsorted(edges, ids, "right").astype(np.int64) * wide
        for hot, own in cuts.items():
            # what comes after the hot id in its group comes after its last part
            group = np.searchsorted(edges, hot, "right") * wide
            found[(found == group) & (ids > hot)] += len(own) + 1
            for i in np.flatnonzero(ids == hot).tolist():
                key = (prefix[i], digest[i])
                lo, hi = bisect_left(own, key), bisect_right(own, key)
                found[i] += lo + tie[i] % (hi - lo + 1)
        return pd.Series(found)

    return place


def _parts(docs: DataFrame, hot: dict[int, int]) -> dict[int, list[tuple]]:
    """For each hot id the (prefix, digest) that part its rows evenly, from a sample of them."""
    if not hot:
        return {}
    rows = docs.where(F.col("k").isin(list(hot))).select("k", "prefix", "digest")
    many = rows.count()
    share = min(1.0, _KEYS * sum(hot.values()) / many)
    keys: dict[int, list[tuple]] = {k: [] for k in hot}
    for r in rows.sample(share, 1).collect():
        keys[r["k"]].append((r["prefix"], r["digest"]))
    return {k: [own[len(own) * i // parts] for i in range(1, parts)] if (own := sorted(keys[k])) else [] for k, parts in hot.items()}


def _with_next(docs: DataFrame) -> DataFrame:
    """The documents in groups of consecutive ids, each group followed by the first document of the next
    one (marked ``extra``; after the last group: of the first), so that a task which reads a group in order
    knows each document's successor. One shuffle; only the groups' bounds and first keys, a few for each
    shuffle partition, pass through the driver. NULL ids come first; equal ids are ordered by text. An id with more
    rows than a group's share is parted into several groups, its rows ordered by the first characters of their texts,
    then by digest; of those only rows like a group's first go to the group before."""
    spark = docs.sparkSession
    least = -(1 << 63)
    docs = docs.withColumn("k", F.coalesce("doc_id", F.lit(least)))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10 * n).alias("b")).first()["b"] or []
    edges, counts = np.unique(np.array(bounds, np.int64), return_counts=True)
    hot = {k: c for k, c in zip(edges.tolist(), counts.tolist(), strict=True) if c > 1}  # fewer than n
    is_hot = F.col("k").isin(list(hot)) if hot else F.lit(False)
    text = F.coalesce("text", F.lit(""))
    docs = docs.withColumns({"prefix": F.when(is_hot, F.substring(text, 1, PREFIX)), "digest": F.when(is_hot, F.xxhash64(text))})

    # rows that are alike are told apart by their place in the input
    tie = F.when(is_hot, F.abs(F.xxhash64(F.monotonically_increasing_id()) % (1 << 31)))
    placed = docs.withColumn("g", _place_of(edges, _parts(docs, hot))("k", "prefix", "digest", F.coalesce(tie, F.lit(0))))
    firsts = placed.groupBy("g").agg(F.min("k").alias("k"), F.min(F.when(is_hot, F.struct("k", "prefix", "digest"))).alias("own")).collect()
    firsts = {r["g"]: (r["k"], *((r["own"]["prefix"], r["own"]["digest"]) if r["own"] and r["own"]["k"] == r["k"] else (None, None))) for r in firsts}
    order = sorted(firsts)
    heads = spark.createDataFrame([(g, *firsts[g], order[i - 1]) for i, g in enumerate(order)], "hg bigint, hk bigint, hp string, hd bigint, before bigint")
    # at most one row for each group, so it may be broadcast whatever the corpus
    same = (F.col("g") == F.col("hg")) & (F.col("k") == F.col("hk")) & F.col("prefix").eqNullSafe(F.col("hp")) & F.col("digest").eqNullSafe(F.col("hd"))
    placed = placed.join(F.broadcast(heads), same, "left")
    to = F.array(F.struct(F.col("g").alias("g"), F.lit(False).alias("extra")), F.struct(F.col("before").alias("g"), F.lit(True).alias("extra")))
    to = F.explode(F.filter(to, lambda x: x["g"].isNotNull()))
    return placed.select("doc_id", "text", "k", "prefix", "digest", to.alias("to")).select("to.g", "to.extra", "doc_id", "k", "prefix", "digest", "text")


def versions(docs: DataFrame) -> DataFrame:
    """For each document (``doc_id``, ``text``) its fingerprint, that of its edited text (the last quarter of
    its characters replaced by the first as many of the next document), and its likeness to the edited and to
    the next text. A NULL text is an empty one. Repeated rows are documents of their own."""
    spread = _with_next(id_text(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: tuple = ([], [], [], [])  # the last document read: group, extra, id, text
        for batch, texts in by_slices(batches, "text"):
            g, extra, ids = ([*old, *batch.column(c).to_pylist()] for old, c in zip(carry, ("g", "extra", "doc_id"), strict=False))
            texts = [*carry[3], *texts]
            firsts = np.array([i for i in range(len(g) - 1) if g[i] == g[i + 1] and not extra[i]], np.int64)
            if len(firsts):
                yield _results(ids, texts, firsts)
            carry = (g[-1:], extra[-1:], ids[-1:], texts[-1:])

    ordered = spread.repartition("g").sortWithinPartitions("g", "extra", "k", "prefix", "digest", "text")
    return ordered.select("g", "extra", "doc_id", "text").mapInArrow(run, RESULT)
