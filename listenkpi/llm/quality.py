"""Document quality: a sparse ensemble of conjunctive rules over text statistics.

1. Statistics of every whole text (shares of character kinds, word and line lengths, repetition).
2. Shallow trees, grown in numpy on resampled rows and columns of a bounded labelled sample. Every path
   from a root to a node is a rule: a conjunction of ``statistic <= x`` and ``statistic > x``.
3. Lasso logistic regression over the rules (accelerated proximal gradient) keeps few of them.
4. The kept rules are compiled into one Spark column expression over the statistics, so scoring is part
   of the scan of the documents, without a shuffle.

The sample holds at most ``PER_CLASS`` labelled rows of each class, the first by a hash of their id,
outside the held-out fold; rows are weighted back to the classes' shares among all labelled rows, so the
score is a probability at those shares. Thresholds, rules and weights are fitted at every size alike.

Defined results: NULL and empty texts have all statistics 0 and get the score that the rules give those.
Labels that contradict each other for one id count as 0; NULL labels and ids are not learned from. With
labelled rows of one class only, every score is that class; with none it is 0.0.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.llm.common import bounded_sample, fold, id_text
from listenkpi.llm.learn import text_column

MODULUS, REMAINDER = 4, 2
PER_CLASS = 3000
THRESHOLD = 0.7
TREES, DEPTH, LEAF, BINS = 60, 3, 15, 32
PENALTY, STEPS = 0.002, 400

STATISTICS = ["n_chars", "n_words", "n_lines", "word_chars", "line_words", "sentence_words", "upper", "lower", "digit", "space",
              "stop_punct", "bang", "pipe", "symbol", "other_punct", "non_ascii", "distinct_words", "top_word", "same_as_last",
              "distinct_sentences", "distinct_lines", "short_words", "long_words", "capital_words"]
STATS = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])

#: Character kinds by byte; the numbers are positions in ``_KINDS``.
_KINDS = ["upper", "lower", "digit", "space", "stop_punct", "bang", "pipe", "symbol", "other_punct", "non_ascii"]


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 0x80:
        return 9
    if c.isupper():
        return 0
    if c.islower():
        return 1
    if c.isdigit():
        return 2
    if c.isspace():
        return 3
    return 4 if c in ".,;:'\"" else 5 if c in "!?" else 6 if c in "|" else 7 if c in "#$%&*+=<>@^_~\\/{}[]" else 8


_KIND_OF = np.array([_kind(b) for b in range(256)], np.uint8)
_SENTENCE_END = str.maketrans({"!": ".", "?": ".", "\n": "."})


def statistics(texts: list[str]) -> pd.DataFrame:
    """One row of ``STATISTICS`` for each text, over the whole text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    at = {s: i for i, s in enumerate(STATISTICS)}
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        kinds = np.bincount(_KIND_OF[raw], minlength=len(_KINDS)) / len(raw)
        row = out[i]
        row[at["upper"]:at["non_ascii"] + 1] = kinds
        words = text.split()
        lines = [x for x in text.split("\n") if x]
        sentences = [x for x in map(str.strip, text.translate(_SENTENCE_END).split(".")) if x]
        row[at["n_chars"]], row[at["n_words"]], row[at["n_lines"]] = len(text), len(words), len(lines)
        if words:
            n, counted, sizes = len(words), Counter(words), np.fromiter(map(len, words), np.int64)
            row[at["word_chars"]] = sizes.mean()
            row[at["line_words"]] = n / max(1, len(lines))
            row[at["sentence_words"]] = n / max(1, len(sentences))
            row[at["distinct_words"]] = len(counted) / n
            row[at["top_word"]] = max(counted.values()) / n
            row[at["same_as_last"]] = sum(map(eq, words, words[1:])) / n
            row[at["short_words"]], row[at["long_words"]] = (sizes <= 3).mean(), (sizes >= 10).mean()
            row[at["capital_words"]] = sum(map(str.istitle, words)) / n
        if sentences:
            row[at["distinct_sentences"]] = len(set(sentences)) / len(sentences)
        if lines:
            row[at["distinct_lines"]] = len(set(lines)) / len(lines)
    return pd.DataFrame(out, columns=STATISTICS)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic's number, whether <=, threshold), in order


def _grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, cuts: list[np.ndarray], rng, depth: int, path: Rule) -> list[Rule]:
    """The paths below one node: the split of the largest weighted Gini gain among some columns."""
    if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
        return []
    best = (1e-9, None, None)
    total, ones = w.sum(), (w * y).sum()
    impurity = lambda n, p: n - (p * p + (n - p) ** 2) / np.maximum(n, 1e-12)
    for c in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
        if not len(cuts[c]):
            continue
        bins = np.searchsorted(cuts[c], x[:, c], "left")  # x <= cuts[k] is bin <= k
        n = np.cumsum(np.bincount(bins, w, len(cuts[c]) + 1))[:-1]
        p = np.cumsum(np.bincount(bins, w * y, len(cuts[c]) + 1))[:-1]
        rows = np.cumsum(np.bincount(bins, minlength=len(cuts[c]) + 1))[:-1]
        gain = impurity(total, ones) - impurity(n, p) - impurity(total - n, ones - p)
        gain[(rows < LEAF) | (len(y) - rows < LEAF)] = -1
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], c, float(cuts[c][k]))
    if best[1] is None:
        return []
    c, cut = int(best[1]), best[2]
    out: list[Rule] = []
    for below in (True, False):
        side = (x[:, c] <= cut) == below
        own = (*path, (c, below, cut))
        out += [own, *_grow(x[side], y[side], w[side], cuts, rng, depth - 1, own)]
    return out


def _short(rule: Rule) -> Rule:
    """The same conjunction with one bound for each statistic and side."""
    tight: dict[tuple[int, bool], float] = {}
    for c, below, cut in rule:
        tight[c, below] = (min if below else max)(cut, tight.get((c, below), cut))
    return tuple((c, below, cut) for (c, below), cut in sorted(tight.items()))


def rules_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int = 0) -> list[Rule]:
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1])) for c in range(x.shape[1])]
    found: set[Rule] = set()
    for _ in range(TREES):
        rows = rng.choice(len(y), len(y), replace=True)
        found |= {_short(r) for r in _grow(x[rows], y[rows], w[rows], cuts, rng, DEPTH, ())}
    return sorted(found)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, c] <= cut) == below for c, below, cut in rule])


def lasso(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the centred rules and the bias under an L1 penalty: accelerated proximal gradient."""
    w = w / w.sum()
    centre = w @ z
    z = z - centre
    step = 4 / max(1e-9, np.linalg.eigvalsh((z * w[:, None]).T @ z)[-1] + 1)
    beta, bias, last, last_bias, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0, 1.0
    for _ in range(STEPS):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = beta + (t - 1) / t_next * (beta - last), bias + (t - 1) / t_next * (bias - last_bias)
        error = w * (1 / (1 + np.exp(-np.clip(z @ ahead + ahead_bias, -40, 40))) - y)
        last, last_bias, t = beta, bias, t_next
        moved = ahead - step * (z.T @ error)
        beta = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        bias = ahead_bias - step * error.sum()
    return beta, float(bias - centre @ beta)


class Model:
    """``rules`` with their ``weights`` and the ``bias``; ``columns`` names the statistics."""

    def __init__(self, rules: list[Rule], weights: np.ndarray, bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def column(self, stats: str) -> Column:
        """The rules as one column expression over the struct column ``stats``: the probability of label 1."""
        total = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            both = None
            for c, below, cut in rule:
                s = F.col(f"{stats}.{STATISTICS[c]}")
                one = s <= F.lit(cut) if below else s > F.lit(cut)
                both = one if both is None else both & one
            total = total + F.when(both, F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def told(self) -> list[tuple[str, float]]:
        """The rules as text, the heaviest first."""
        text = [" and ".join(f"{STATISTICS[c]} {'<=' if below else '>'} {cut:.6g}" for c, below, cut in r) for r in self.rules]
        return sorted(zip(text, self.weights.tolist(), strict=True), key=lambda x: -abs(x[1]))


def train(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Model:
    rules = rules_of(x, y, w)
    z = np.stack([holds(r, x) for r in rules], 1).astype(float) if rules else np.zeros((len(y), 0))
    keep = [k for k in range(z.shape[1]) if 0 < z[:, k].sum() < len(y)]
    _, first = np.unique(z[:, keep], axis=1, return_index=True) if keep else (None, [])
    keep = [keep[k] for k in sorted(first)]  # of rules that hold for the same rows one is enough
    if not keep:
        share = float((w * y).sum() / w.sum())
        return Model([], np.zeros(0), float(np.log(share / (1 - share))))
    beta, bias = lasso(z[:, keep], y, w)
    some = np.flatnonzero(beta)
    return Model([rules[keep[k]] for k in some], beta[some], bias)


def with_statistics(docs: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    return docs.withColumn(into, text_column(statistics, STATS)(F.col(text_col).cast("string")))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, learned from labelled rows of ``docs`` (``doc_id, text``) outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id IS NOT NULL AND quality IN (0, 1)").where(fold("doc_id", MODULUS) != REMAINDER)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    sample = bounded_sample(known, "doc_id", "quality", {0: PER_CLASS, 1: PER_CLASS})
    rows = with_statistics(docs.join(F.broadcast(sample), "doc_id"), "s").select("doc_id", "quality", "s.*").toPandas()
    rows = rows.sort_values(["doc_id", *STATISTICS])
    x, y = rows[STATISTICS].to_numpy(), rows["quality"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return Model([], np.zeros(0), np.inf if len(y) and y[0] else -np.inf)
    w = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    return train(x, y, w / w.mean())


def scored(docs: DataFrame, labels: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score in the column ``into``."""
    stats = f"{into}__stats"
    while stats in docs.columns:
        stats += "_"
    model = fit(id_text(docs, text_col=text_col), labels)
    return with_statistics(docs, stats, text_col).withColumn(into, model.column(stats)).drop(stats)
