import numpy as np
import pytest
from pyspark.sql import functions as F

from listenkpi.llm import ann, tiles

SCHEMA = "vec_id bigint, embedding array<double>, rank string, score string"


def brute(rows, k, every):
    """``(query, rank, id, score)`` by comparing each query with each row."""
    width = max(len(v) for _, v in rows)
    known = [(i, list(v) + [0.0] * (width - len(v))) for i, v in rows]
    asked = {i: min(tuple(v) for j, v in rows if j == i) for i, _ in rows if i % every == 0}
    out = []
    for q, v in asked.items():
        v = list(v) + [0.0] * (width - len(v))
        found = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in known if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def told(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_equal_to_brute_force_over_many_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(24).round(3).tolist()) for i in range(600)]
    rows += [(600 + i, rows[3][1]) for i in range(300)]  # a third is one vector
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(5)
    for block, group in ((64, 8), (4096, 8192)):
        got, want = told(ann.nearest(df, k=7, block=block, group=group)), brute(rows, 7, 20)
        assert [(a, b, c) for a, b, c, _ in got] == [(a, b, c) for a, b, c, _ in want]
        assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-14)


def test_bounds_hold_and_choose(spark):
    """The error bound holds for nearly all pairs, and leaves over half of the rows unranked."""
    rng = np.random.default_rng(2)
    width, turn = 256, ann.rotation(256)
    vecs, asks = rng.standard_normal((4000, width)), rng.standard_normal((50, width))
    code, f, e = ann.encode(vecs, vecs.mean(0), turn)
    guess = (asks @ turn) @ (np.unpackbits(code, axis=1)[:, :width] * 2.0 - 1).T * f
    true = asks @ (vecs - vecs.mean(0)).T
    off = np.abs(guess - true) / (e * np.linalg.norm(asks, axis=1)[:, None])
    assert (off < ann.ERRORS).mean() > 0.995 and abs((guess - true).mean()) < 0.05 * np.std(true)
    best = np.sort(true, axis=1)[:, -20]
    assert (guess + ann.ERRORS * e * np.linalg.norm(asks, axis=1)[:, None] >= best[:, None]).mean() < 0.5  # of vectors without any structure


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [5.0, 5.0]), (7, [3.0]), (8, [0.5, 0.0, 4.0]), (8, [0.5, 0.0, 4.0]), (40, [2.0, 0.0]), (40, [-1.0, 0.0])]
    good = [(i, v) for i, v in rows if i in (0, 20, 7, 8, 40)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    assert told(ann.nearest(df)) == brute(good, 20, 20)
    assert ann.nearest(df.limit(0)).count() == 0 and ann.nearest(df.where("vec_id = 7")).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0  # no other row
    assert ann.nearest(df).columns == ["query_id", "rank", "vec_id", "score"]


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for q, _, i, _ in told(ann.nearest(df)):
        got.setdefault(q, set()).add(i)
    rows = df.toPandas()
    ids, vecs = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    hit = n = 0
    for q in got:
        score = vecs @ vecs[ids == q][0]
        score[ids == q] = -np.inf
        hit, n = hit + len(got[q] & set(ids[np.lexsort((ids, -score))[:20]].tolist())), n + 20
    assert hit / n >= 0.99


@pytest.mark.parametrize("block", [3, 1000])
def test_blocks_hold_every_row_once(spark, block):
    df = spark.range(50).select("id", F.array(F.col("id").cast("double")).alias("vec")).repartition(3)
    made = tiles.packed(df, 1, lambda task, k: task, lambda b: np.zeros((b.num_rows, 1)), block).collect()
    ids = [np.frombuffer(r["ids"], "<i8") for r in made]
    assert sorted(np.concatenate(ids).tolist()) == list(range(50)) and max(map(len, ids)) <= block
    assert all(np.frombuffer(r["vecs"], "<f8").tolist() == i.tolist() for r, i in zip(made, ids, strict=True))
