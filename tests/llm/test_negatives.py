import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listenkpi.llm import negatives as N

SCHEMA = "vec_id bigint, embedding array<double>, label int, slot string"


def brute(rows, every=50):
    """By comparing each anchor with each row, in Python's integers."""
    width = max((len(v) for _, v, _ in rows), default=0)
    known = [(i, [math.floor(256 * x) for x in v] + [0] * (width - len(v)), lab) for i, v, lab in rows]
    known = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in known]
    anchors = {}
    for i, v, lab in sorted(known, key=lambda r: (r[0], r[2], r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, lab))
    out = []
    for a, (v, lab) in anchors.items():
        found = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, own) for i, w, own in known if i != a)
        for p, i, _ in [x for x in found if x[2] == lab][:5]:
            inside = [x for x in found if x[2] != lab and 50 * -p <= 100 * -x[0] <= 95 * -p][:3]
            out += [(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(df, **kw):
    got = N.hard_negatives(df, label=N.relabelled(F.col("label"), F.col("vec_id")), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_equal_to_brute_force_over_many_tiles(spark):
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0.05, 0.3), 2) for _ in range(12)], rng.randrange(4)) for i in range(700)]
    rows += [(700 + i, rows[5][1], rng.randrange(2)) for i in range(350)]  # a third is one vector: ties by id
    df = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA).repartition(4)
    want = brute(rows)
    assert len(want) > 100
    for block, group in ((96, 5), (4096, 8192)):
        assert mined(df, block=block, group=group) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 0), (1, [1.0, 0.4], 0), (2, [0.9], 0), (3, [0.6, 0.3], 2), (3, [0.6, 0.3], 2), (4, [0.7, 0.1, 9.0], 2), (50, [-1.0, 0.0], 3),
            (50, [-1.0, 0.0], 3), (51, [-0.5, 0.0], 3), (52, [1e300, 1.0], 1), (100, [1.0, 1e200], 1), (101, [0.3, 0.3], 1), (102, [0.2, 0.1], 5)]
    odd = [(5, None, 0), (6, [], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (None, [1.0, 1.0], 0), (11, [1.0, 0.5], None)]
    df = spark.createDataFrame([(*r, "s") for r in good + odd], SCHEMA)
    small = [r for r in good if r[0] not in (52, 100)]
    got = mined(df.where("coalesce(vec_id, 0) NOT IN (52, 100)"))
    assert got == brute(small) and got
    assert all(abs(s) < 1 << 63 for r in mined(df) for s in r[4:])  # out of range: at the bounds
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 1")) == [] and mined(df.where("vec_id = 0")) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 8), st.integers(0, 2**32))
def test_strassen_is_exact(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-2**24, 2**24, (m, k)), rng.integers(-2**24, 2**24, (k, n))
    assert (N.strassen(a, b, leaf) == a @ b).all()
    big = a.astype(object) * 2**40
    assert (N.strassen(big, b.astype(object), leaf) == big @ b.astype(object)).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(1, 30), st.integers(1, 5), st.integers(1, 6), st.integers(0, 2**32))
def test_heaps_merge(rows, n, size, cuts, seed):
    rng = np.random.default_rng(seed)
    found = rng.integers(-3, 4, (rows, n))
    found[rng.random((rows, n)) < 0.3] = N._NONE
    heaps = N.Heaps(rows, size)
    parts = np.array_split(rng.permutation(n), cuts)
    for part in parts:
        part = np.sort(part)
        if len(part):
            heaps.offer(np.arange(rows), found[:, part].copy(), part)
    at, score, name, _ = heaps.entries()
    for r in range(rows):
        want = sorted((-s, j) for j, s in enumerate(found[r].tolist()) if s > N._NONE)[:size]
        assert [(-s, j) for a, s, j in zip(at, score.tolist(), name.tolist(), strict=True) if a == r] == want
