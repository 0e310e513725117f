import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenkpi.llm import langid, ngrams, quality, toxicity

SF01 = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = (y == 1).sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def brute_bag(text, sizes, digits):
    keep = lambda b: 0x61 <= b <= 0x7A or b >= 0x80 or (digits and 0x30 <= b <= 0x39)
    words = bytes(b if keep(b) else 32 for b in text.lower().encode()).split()
    return sorted(w[i:i + n] for w in (b" " + w + b" " for w in words) for n in sizes for i in range(len(w) - n + 1) if w[i:i + n].strip())


@pytest.mark.parametrize("digits", [True, False])
def test_ngrams_equal_brute_force(digits):
    texts = ["", "A", "ab 12 c3d!", "Éa—b  ñ", "x" * 3000, "  .. "]
    for sizes in ((3, 4, 5, 6), (1, 2, 3, 4)):
        data, ends = ngrams.folded(texts, digits)
        found = {n: [] for n in range(len(texts))}
        for n, (at, _) in zip(sizes, ngrams.buckets(data, sizes, 12), strict=False):
            for a in at.tolist():
                found[int(np.searchsorted(ends, a, "right")) - 1].append(bytes(data[a:a + n]))
        for k, t in enumerate(texts):
            assert sorted(found[k]) == brute_bag(t, sizes, digits), t
        weights = np.random.default_rng(0).normal(size=(1 << 12, 2))
        means, some = ngrams.means(texts, weights, sizes, digits)
        for k, (ids, share) in enumerate(ngrams.bags(texts, sizes, 12, digits)):
            assert np.allclose(means[k], (weights[ids] * share[:, None]).sum(0), atol=1e-5) and some[k] == (len(ids) > 0)


EDGE = [(1, None), (2, ""), (3, "123 ... !!"), (None, "a text"), (4, "word " * 60_000), (4, "word " * 60_000), (5, "漢字")]


def _docs(spark, extra=""):
    return spark.createDataFrame([(*r, "en") for r in EDGE], "doc_id bigint, text string, lang string").selectExpr("*", *([extra] if extra else []))


def test_toxicity_learns_and_shares_subwords(spark):
    rows, labels = [], []
    rng = np.random.default_rng(1)
    for i in range(400):
        words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            for k in (3, 17, 30):
                words[k] = "horribulous"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = {r["doc_id"]: r["s"] for r in toxicity.scored(docs, known, "s").collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert auc(np.array([out[i] for i in held]), np.array([labels[i][2] for i in held])) > 0.99
    # a spelling never seen scores above a neutral word in the same place
    misspelt = spark.createDataFrame([(1, rows[1][1] + " horibulous" * 3), (2, rows[1][1] + " bcdfghhabi" * 3)], "doc_id bigint, text string")
    a, b = (r["s"] for r in misspelt.withColumn("s", toxicity.scorer(toxicity.fit(docs, known))(F.col("text"))).orderBy("doc_id").collect())
    assert a > b


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(4, 1, 1), (1, 1, 0), (None, 1, 1), (5, None, None), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    docs = _docs(spark, "0.5 as toxicity")
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(EDGE)
    got = toxicity.scored(docs, labels, "s").collect()
    assert len(got) == len(EDGE) and all(0 <= r["s"] <= 1 for r in got)
    assert len({r["s"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert {r["s"] for r in toxicity.scored(docs, labels.limit(0), "s").collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), labels, "s").count() == 0
    only = spark.createDataFrame([(4, 1, 1)], labels.schema)
    assert {r["s"] for r in toxicity.scored(docs, only, "s").collect()} == {1.0}


def test_language_edges(spark):
    docs = _docs(spark, "'x' as score")
    got = sorted((str(r["doc_id"]), r["f"]["lang"], r["f"]["score"]) for r in langid.predicted(docs, "f").collect())
    assert got == [("1", "und", 0.0), ("2", "und", 0.0), ("3", "und", 0.0), *[(d, "en", 1.0) for d in ("4", "4", "5", "None")]]
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["f"]["lang"] for r in langid.predicted(none, "f").collect()} == {"und"}
    assert langid.predicted(docs.limit(0), "f").count() == 0


def test_language_families_and_heldout(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(docs)
    assert model.groups == {None: ["germanic", "romance"], "germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert model.pairs == [(None, 0, 1), ("germanic", 0, 1), ("romance", 0, 1)]
    rows = [r for r in langid.predicted(docs, "f").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang"] == r["f"]["lang"] for r in rows]) > 0.97


def test_quality_heldout_and_compiled_rules(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    assert model.rules and all(w for w in model.weights)
    rows = quality.with_statistics(docs, "st").withColumn("score", model.column("st")).join(labels, "doc_id").collect()
    x = np.array([[r["st"][s] for s in quality.STATISTICS] for r in rows])
    plain = 1 / (1 + np.exp(-(model.bias + sum(w * quality.holds(r, x) for r, w in zip(model.rules, model.weights, strict=True)))))
    assert np.allclose(plain, [r["score"] for r in rows])
    held = [k for k, r in enumerate(rows) if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert auc(plain[held], np.array([rows[k]["quality"] for k in held])) > 0.95


def test_quality_edges(spark):
    labels = spark.createDataFrame([(4, 1, 1), (1, 0, 0), (None, 1, 1), (5, None, None), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    docs = _docs(spark, "0 as score__stats")
    got = quality.scored(docs, labels, "score").collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["s"] for r in quality.scored(docs, labels.limit(0), "s").collect()} == {0.0}
    assert quality.scored(docs.limit(0), labels, "s").count() == 0
    assert quality.statistics(["", "a"])["n_chars"].tolist() == [0, 1]


def test_language_needs_letters():
    model = langid.Model({None: ["germanic"], "germanic": ["en"]}, [], np.zeros((1 << langid.BITS, 0)), np.zeros(0))
    assert model.predict(["\u00b2", "\u00bd", "\u2460 12", "...", "", "\u0660"])["lang"].tolist() == ["und"] * 6
    assert model.predict(["a", "\u6f22", "\u05d0", "\u02b0", "\u00aa"])["lang"].tolist() == ["en"] * 5


def test_language_votes_equal_brute_force():
    """Margins by the definition of the mean, votes and ties by hand."""
    rng = np.random.default_rng(3)
    groups = {None: ["f", "g", "h"], "f": ["a", "b", "c"], "g": ["d"], "h": ["e", "i"]}
    pairs = [(None, 0, -1), (None, 1, -1), (None, 2, -1), ("f", 0, 1), ("f", 0, 2), ("f", 1, 2), ("h", 0, 1)]
    weights, biases = rng.normal(size=(1 << langid.BITS, len(pairs))), rng.normal(size=len(pairs)) / 50
    model = langid.Model(groups, pairs, weights, biases)
    texts = ["one two", "xyzzy", "\u00e9t\u00e9 d'hiver", "words " * 50, *("".join(rng.choice(list("abcdef "), 30)) for _ in range(60))]
    got = model.predict(texts)
    for k, t in enumerate(texts):
        (ids, share), = ngrams.bags([t], langid.SIZES, langid.BITS, False)
        m = (weights[ids] * share[:, None]).sum(0) + biases
        f = max(range(3), key=lambda x: m[x])
        names = groups[groups[None][f]]
        wins, sums, least = ({x: z for x in names} for z in (0, 0.0, np.inf))
        for c, (g, a, b) in enumerate(pairs):
            if g == groups[None][f]:
                wins[names[a] if m[c] >= 0 else names[b]] += 1
                for x, v in ((names[a], m[c]), (names[b], -m[c])):
                    sums[x], least[x] = sums[x] + v, min(least[x], v)
        best = max(names, key=lambda x: (wins[x], sums[x]))
        far = (sorted(m[:3])[2] - sorted(m[:3])[1]) / 2
        assert got["lang"][k] == best and abs(got["score"][k] - 1 / (1 + np.exp(-2 * min(far, least[best])))) < 1e-5
    # a vote tie (each beats one other) goes to the larger sum of margins, then to the first name
    tie = langid.Model({None: ["f"], "f": ["a", "b", "c"]}, [("f", 0, 1), ("f", 0, 2), ("f", 1, 2)], np.zeros((0, 3)), np.zeros(3))
    assert tie.choose("f", np.array([[1.0, -2.0, 3.0], [1.0, -1.0, 1.0]]))[0].tolist() == [1, 0]


def test_all_of_250_languages_are_learned(spark):
    words = lambda k: " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}{chr(97 + (k * 7) % 26)}" for c in "aeiouy")
    rows = [(250 * i + k, f"{words(k)} {i}", f"x{k:03d}") for i in range(6) for k in range(250)]
    rows += [(5000, "repeated " * 5, "x000")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    assert len(model.groups[None]) == 250
    assert langid._sample(docs).count() >= 250 * 3
    got = model.predict([words(k) for k in range(250)])["lang"].tolist()
    assert np.mean([a == f"x{k:03d}" for k, a in enumerate(got)]) > 0.9


def plain_statistics(text):
    """The statistics by their definitions, one character and one word at a time."""
    raw = text.encode()
    kind = lambda b: ("non_ascii" if b >= 128 else "upper" if chr(b).isupper() else "lower" if chr(b).islower() else "digit" if chr(b).isdigit() else "space"
                      if chr(b).isspace() else "stop_punct" if chr(b) in ".,;:'\"" else "bang" if chr(b) in "!?" else "pipe" if chr(b) == "|" else "symbol"
                      if chr(b) in "#$%&*+=<>@^_~\\/{}[]" else "other_punct")
    out = {s: 0.0 for s in quality.STATISTICS}
    for b in raw:
        out[kind(b)] += 1 / len(raw)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    for mark in "!?\n":
        text = text.replace(mark, ".")
    sentences = [x.strip() for x in text.split(".") if x.strip()]
    out.update(n_chars=len(text), n_words=len(words), n_lines=len(lines))
    if words:
        n = len(words)
        out.update(word_chars=sum(map(len, words)) / n, line_words=n / max(1, len(lines)), sentence_words=n / max(1, len(sentences)),
                   distinct_words=len(set(words)) / n, top_word=max(words.count(w) for w in words) / n, same_as_last=sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
                   short_words=sum(len(w) <= 3 for w in words) / n, long_words=sum(len(w) >= 10 for w in words) / n, capital_words=sum(w.istitle() for w in words) / n)
    if sentences:
        out["distinct_sentences"] = len(set(sentences)) / len(sentences)
    if lines:
        out["distinct_lines"] = len(set(lines)) / len(lines)
    return out


def test_quality_statistics_equal_plain_ones(spark):
    texts = ["One two three.\n\nOne two three.\nAnd 42 more!  ", "\u00e9t\u00e9 | <b> #1 (x) \t~", "...", "a a a b", "\n\n", "Word " * 500, "Incomprehensibilities? Yes! Yes!"]
    got = quality.statistics(texts)
    for k, t in enumerate(texts):
        want = plain_statistics(t)
        assert {s: round(float(got[s][k]), 9) for s in quality.STATISTICS} == {s: round(want[s], 9) for s in quality.STATISTICS}, t


def test_toxicity_training_equals_a_plain_one(monkeypatch):
    """One epoch of the joint training against loops over rows, n-grams and cells, in doubles."""
    monkeypatch.setattr(toxicity, "BITS", 5)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "BATCH", 4)
    rng = np.random.default_rng(9)
    bags = []
    for _ in range(9):
        ids = np.sort(rng.choice(32, rng.integers(1, 6), replace=False))
        bags.append((ids, np.full(len(ids), 1 / len(ids), np.float32)))
    bags.append((np.zeros(0, np.int64), np.zeros(0, np.float32)))
    labels = np.array([0, 1, 0, 0, 1, 1, 0, 0, 1, 0])
    got, got_bias = toxicity.train(bags, labels, seed=4)

    rng = np.random.default_rng(4)
    embed, soft, bias = rng.normal(0, 0.01, (32, toxicity.WIDTH)), rng.normal(0, 0.5, (toxicity.WIDTH, 2)), np.zeros(2)
    sq = [np.full(x.shape, 1e-8) for x in (embed, soft, bias)]
    counts = [sum(labels == c) for c in (0, 1)]
    filled = np.array([i for i in range(len(bags)) if len(bags[i][0])])
    for rows in np.array_split(rng.permutation(filled), len(filled) // 4):
        grads = [np.zeros_like(x) for x in (embed, soft, bias)]
        for i in rows:
            mean = sum(embed[b] * s * toxicity.SCALE for b, s in zip(*bags[i], strict=True))
            logits = mean @ soft + bias
            p = np.exp(logits) / np.exp(logits).sum()
            p[labels[i]] -= 1
            p *= len(labels) / (2 * counts[labels[i]]) / len(rows)
            grads[1] += np.outer(mean, p)
            grads[2] += p
            for b, s in zip(*bags[i], strict=True):
                grads[0][b] += soft @ p * s * toxicity.SCALE
        for x, q, g in zip((embed, soft, bias), sq, grads, strict=True):
            q += g**2
            x -= toxicity.RATE * g / np.sqrt(q)
    assert np.allclose(got, embed @ (soft[:, 1] - soft[:, 0]) * toxicity.SCALE, rtol=1e-3, atol=1e-3) and abs(got_bias - (bias[1] - bias[0])) < 1e-4


def test_toxicity_scores_equal_a_plain_forward_pass(spark):
    """The log odds of a text: the mean over its n-grams, found one by one, and the neutral ones."""
    rng = np.random.default_rng(5)
    weights, bias = rng.normal(size=1 << toxicity.BITS).astype(np.float32), 0.25
    texts = ["bad words, bad words", "", "caf\u00e9 42x", "x" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["s"] for r in docs.withColumn("s", toxicity.scorer((weights, bias))(F.col("text"))).collect()}
    for k, t in enumerate(texts):
        once = " ".join(dict.fromkeys(bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in t.lower().encode()).decode().split()))
        total, n = 0.0, 0
        data, _ = ngrams.folded([once], True)
        for _, ids in ngrams.buckets(data, toxicity.SIZES, toxicity.BITS) if len(data) else []:
            for b in ids.tolist():
                total, n = total + float(weights[b]), n + 1
        assert n == len(brute_bag(once, toxicity.SIZES, True))
        assert abs(got[k] - 1 / (1 + np.exp(-(total / max(1, n + toxicity.NEUTRAL) + bias)))) < 1e-6


def test_quality_split_and_lasso_equal_their_definitions():
    rng = np.random.default_rng(6)
    x, w = rng.normal(size=(120, 1)), rng.uniform(0.5, 2, 120)
    y = ((x[:, 0] > 0.3) ^ (rng.random(120) < 0.1)).astype(float)
    cuts = [np.unique(np.quantile(x[:, 0], np.linspace(0, 1, 9)[1:-1]))]
    gini = lambda own: 1 - ((w[own] @ y[own] / w[own].sum()) ** 2 + (1 - w[own] @ y[own] / w[own].sum()) ** 2)
    gain = {c: w.sum() * gini(x[:, 0] == x[:, 0]) - sum(w[own].sum() * gini(own) for own in (x[:, 0] <= c, x[:, 0] > c)) for c in cuts[0].tolist()}
    rules = quality._grow(x, y, w, cuts, np.random.default_rng(0), 1, ())
    best = max(gain, key=gain.get)
    assert rules == [((0, True, best),), ((0, False, best),)]
    # at the lasso's optimum each slope is within the penalty, and equals it against the sign where the weight isn't zero
    z = (rng.random((300, 6)) < 0.4).astype(float)
    label = (rng.random(300) < 1 / (1 + np.exp(-(2 * z[:, 0] - 1.5 * z[:, 1])))).astype(float)
    share = rng.uniform(0.5, 2, 300)
    beta, bias = quality.lasso(z, label, share)
    error = share / share.sum() * (1 / (1 + np.exp(-(z @ beta + bias))) - label)
    slope = (z - share / share.sum() @ z).T @ error
    assert abs(error.sum()) < 1e-5 and beta[0] > 0 > beta[1]
    for b, g in zip(beta, slope, strict=True):
        assert abs(g + np.sign(b) * quality.PENALTY) < 2e-4 if b else abs(g) <= quality.PENALTY + 1e-4
