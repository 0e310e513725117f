import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from listenkpi.llm import iblt as B


def bags(texts):
    keys, starts = B.digests(texts)
    return [Counter(keys[a:b].tolist()) for a, b in zip(starts, starts[1:], strict=False)]


def like(a, b):
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 1.0


TEXTS = ["", " \n\t ", "one", "one two three four", "line one\nline two\nline three\n", "same " * 500, "x" * 9000, "é ñ 漢字 ß\n" * 7,
         " ".join(random.Random(3).choices([f"w{i}" for i in range(900)], k=4000)),
         " ".join(random.Random(4).choices([f"w{i}" for i in range(900)], k=4000))]


def test_digests_depend_on_the_text_alone():
    together = bags(TEXTS)
    assert [bags([t])[0] for t in TEXTS] == together
    assert [bags([t])[0] for t in reversed(TEXTS)] == together[::-1]
    assert together[0] == together[1] == Counter()
    assert len(together[5]) == sum(together[5].values()) > 5  # repeats are elements of their own


def test_peeling_recovers_exactly_the_differences():
    keys, starts = B.digests(TEXTS)
    own = bags(TEXTS)
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(len(TEXTS)) for j in range(len(TEXTS))], strict=True))
    key, pair, sign = B.differences(keys, starts, a, b)
    for p in range(len(a)):
        got = {s: Counter(key[(pair == p) & (sign == s)].tolist()) for s in (1, -1)}
        assert got[1] == own[a[p]] - own[b[p]] and got[-1] == own[b[p]] - own[a[p]]
    assert np.allclose(B.likeness(keys, starts, a, b), [like(own[x], own[y]) for x, y in zip(a, b, strict=True)])


def test_failure_retries_larger():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 63, 4000).astype(np.uint64)
    starts = np.array([0, 2000, 4000])
    small = B.Cells(np.array([4]))
    small.add(keys[:2000], np.zeros(2000, np.int64), 1)
    *_, left = small.peel()
    assert left.tolist() == [0]
    key, _, sign = B.differences(keys, starts, np.array([0]), np.array([1]))
    assert sorted(key[sign == 1].tolist()) == sorted(keys[:2000].tolist()) and sorted(key[sign == -1].tolist()) == sorted(keys[2000:].tolist())


def test_equal_texts_have_equal_sketches():
    told = B.sketches(*B.digests([*TEXTS, *TEXTS]))
    assert told[:len(TEXTS)] == told[len(TEXTS):]
    assert len(set(told)) == len(TEXTS) - 1  # the two without paragraphs are alike


ROWS = [(4, "d " * 30), (1, "a b c d e f g h"), (3, None), (2, "i j k l m n o p"), (7, ""), (9, "long text " * 20_000), (9, "again"), (None, "no id")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_versions_equal_brute_force(spark, partitions):
    docs = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id bigint, text string, n_chars int").repartition(partitions)
    got = B.versions(docs).collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(ROWS)
    rows = {(r["doc_id"], r["n_chars"]): r for r in got}
    for (d, t), (_, x) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, x = t or "", x or ""
        edited = t[:len(t) - len(t) // 4] + x[:len(t) // 4]
        r = rows[d, len(t)]
        a, e, n = bags([t, edited, x])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple(B.sketches(*B.digests([t, edited])))
        assert abs(r["near_edited"] - like(a, e)) < 1e-12 and abs(r["near_next"] - like(a, n)) < 1e-12


def test_small_tables_and_repeats(spark):
    assert B.versions(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    one = B.versions(spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(1, 1.0)]
    two = B.versions(spark.createDataFrame([(1, "a b c d")] * 3, "doc_id bigint, text string")).collect()
    assert [r["near_next"] for r in two] == [1.0] * 3


def test_compare_tells_what_was_removed_and_added(spark):
    rows = [(1, "first line here\nsecond line here", "first line here\nthird line there"), (2, None, ""), (3, "a", "a")]
    got = {r["id"]: r["c"] for r in B.compare(spark.createDataFrame(rows, "id int, old string, new string"), "old", "new", "c").collect()}
    a, b = bags(rows[0][1:])
    signed = lambda c: sorted(np.array(list(c), np.uint64).view(np.int64).tolist())
    assert got[1]["removed"] == signed(a - b) and got[1]["added"] == signed(b - a) and 0 < got[1]["likeness"] < 1
    assert (got[2]["likeness"], got[3]["likeness"], got[3]["removed"]) == (1.0, 1.0, [])


@pytest.mark.parametrize("same", [False, True])
def test_a_hot_id_is_parted(spark, same):
    """A third of the rows without id, with texts of their own or all alike: no group has over twice its share, but for
    the rows like a neighbour's first, and each row is followed by the next in order."""
    n = 3000
    rows = [(None if i % 3 == 0 else i, "the same text" if same and i % 3 == 0 else f"{i * 7919 % n:05d} words of this text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    sizes = {(r["g"], r["extra"]): r["count"] for r in B._with_next(docs).groupBy("g", "extra").count().collect()}
    share = n / (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = {g: c for (g, extra), c in sizes.items() if not extra}
    assert sum(own.values()) == n and max(own.values()) <= 2 * share
    assert all(c == 1 for (_, extra), c in sizes.items() if extra) or (same and all(c <= 2 * share for c in sizes.values()))
    got = B.versions(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted((str(d), hashlib.sha256((t[:len(t) - len(t) // 4] + x[:len(t) // 4]).encode()).hexdigest()) for (d, t), (_, x) in zip(ordered, ordered[1:] + ordered[:1], strict=True))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in got) == want
