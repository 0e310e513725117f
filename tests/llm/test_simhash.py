import random

import numpy as np
import pytest
import xxhash

from listenkpi.llm import simhash as S


def brute_fp(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ")
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", " ".join(words))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_fingerprints_equal_brute_force():
    texts = ["", " \t\n", "One", "one TWO", "a b c", "A  b c d\x0be", "x " * 30_000, "É è ñ ß 漢 字 " * 50,
             *(" ".join(random.Random(i).choices(["ab", "cd", "ef", "gh"], k=i)) for i in range(40))]
    assert S.fingerprints(texts).tolist() == [brute_fp(t) for t in texts]


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_pairs_equal_brute_force(spark, max_bits):
    rng = random.Random(max_bits)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    fps = {c for c in centres}
    for c in centres:
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    got = {tuple(sorted((r["a"], r["b"]))) for r in S.near_pairs(spark.createDataFrame([(x,) for x in signed], "fp bigint"), max_bits).collect()}
    arr = np.array(signed, np.int64).view(np.uint64)
    far = np.bitwise_count(arr[:, None] ^ arr[None, :])
    want = {tuple(sorted((signed[i], signed[j]))) for i, j in zip(*np.nonzero(far <= max_bits), strict=True) if i < j}
    assert got == want


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(100, 200)] + [(7, 5), (5, 3), (-9, -8)]
    got = {r["v"]: r["label"] for r in S.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 201)}, 7: 3, 5: 3, 3: 3, -9: -9, -8: -9}


ROWS = [(5, "the same words here again"), (3, "THE same  words here again"), (9, None), (4, ""), (8, "other words altogether now"),
        (8, "other words altogether now"), (None, "the same words here again"), (None, "nobody knows this text"), (11, "long " * 40_000)]


def test_groups_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id bigint, text string, fp string, component_id int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 4), (4, 4), (8, 8), (8, 8), (None, 3), (None, None), (11, 11)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, 4, 8, 11, None, None], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.near_duplicates(docs).count() == 0 and S.keep_one(docs).count() == 0


def test_one_id_with_different_texts_loses_none(spark):
    a, b, c = "the first text has words of its own", "nothing in common with that other one at all", "a third body which is unlike both"
    rows = [(3, a), (5, a), (5, b), (7, c), (7, b.upper()), (7, c), (9, None), (9, "")]
    kept = S.keep_one(spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id bigint, text string, gone_id string, digest int"))
    assert kept.columns == ["doc_id", "text", "gone_id", "digest"]
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(3, a), (5, b), (7, c), (9, "")]


def test_one_id_that_is_the_least_of_several_groups(spark):
    a, b = "the first text has words of its own", "nothing in common with that other one at all"
    rows = [(5, a), (5, b), (6, a), (8, b), (8, "a third body which is unlike both"), (5, b)]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == [(5, b), (5, a), (8, "a third body which is unlike both")]


def test_meetings_do_not_grow_with_the_square(spark):
    """Random fingerprints: four times as many meet about as many others each."""
    each = {}
    for n in (20_000, 80_000):
        fps = np.unique(np.random.default_rng(n).integers(-2**63, 2**63 - 1, n))
        df = spark.createDataFrame(list(zip(fps.tolist())), "fp bigint")
        assert len(S.plant(df, 2)) == 2
        each[n] = S.meetings(df).count() / n
    assert each[20_000] <= 2 * S.MEETS and each[80_000] <= 2 * S.MEETS


def test_trees_are_trees():
    """A child's vantage point depends on the ring above it, and paths of equal segments agree below a shared ring."""
    sample = np.random.default_rng(0).integers(0, 2**63, 4096).astype(np.uint64)
    tree = S.Tree(0, 32, sample, 50_000)
    assert any(len(set(p.tolist())) > 1 for p in tree.points[1:])
    near = sample ^ np.uint64(1 << 9)

    def asks(fps, others):
        """For each fingerprint whether one of its asked shards is the other's."""
        theirs = tree.shards(tree.rings(others))
        found = tree.shards(tree.rings(fps)) == theirs
        for inner, shards in tree.asked(fps):
            found[inner] |= shards == theirs[inner]
        return found

    assert (asks(sample, near) | asks(near, sample)).all()
    deep = S.Tree(0, 32, sample, 10**9)
    assert len(deep.levels) > len(tree.levels) and sum(w for _, w in deep.levels) == 32
