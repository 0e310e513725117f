"""Soft-membership mixing: rates for documents so that expected domain token totals meet target weights.

1. A naive Bayes classifier over hashed words learns the domains of the labelled table and predicts the
   posterior of every domain for every document. A text counts as at most ``STRENGTH`` independent words,
   so posteriors of long texts stay soft.
2. Projected gradient least squares finds nonnegative rates ``r`` (copies of a document in the mix) that
   minimise the squared differences between the expected tokens of each domain, the sum of
   ``rate x tokens x posterior``, and the targets, each weighted by the inverse of the domain's tokens at
   rate 1. Posteriors add up to 1, so with gradients taken per token a step of 1 is safe. Rates begin at 1
   and never go below 0; steps have momentum. A step needs the domains' totals only, one aggregate over
   all documents.

Columns and SQL functions only. Everything about documents stays in tables; the driver sees the word
weights (bounded by ``BUCKETS``) and one total for each domain and step. The classifier learns from at most
``PER_DOMAIN`` labelled documents of each domain, the first by a hash of their id; shares of domains come
from all labelled rows. Tokens are the words between runs of white space.

Defined results: a NULL, empty or blank text has 0 tokens, the domains' shares as posteriors, and a rate
like any other. A domain without labelled rows has the smoothed share of none and no word evidence. A
target of a domain that no document can belong to is left unmet. Targets are scaled to add up to the
tokens of all documents. Steps that end before the targets are met are told in ``missed`` and logged. Labels that contradict each other for one id: the first domain that any
of its rows names (in order of name).
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenkpi.llm.common import bounded_sample, drop_table, write_table

logger = logging.getLogger(__name__)

BUCKETS = 8192
PER_DOMAIN = 3000
STRENGTH = 200.0
STEPS = 60
DEEP = 8  # steps folded into one expression before the rates are written
CLOSE = 1e-6

#: The share of tokens that each domain of the labelled table should have.
TARGETS = {"good": 0.90, "poor": 0.07, "harsh": 0.03}


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled table: ``harsh`` if toxic, else ``poor`` or ``good`` by quality."""
    found = (F.when(F.col("toxic") == 1, "harsh").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good"))
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), found.alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


#: Fixed value: white space as Unicode and Python's ``split`` have it.
SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def words_of(text: Column) -> Column:
    """The text's words in lower case: what stands between runs of white space."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), SPACE, " " * len(SPACE))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it (Spark shares no common
    parts of higher-order functions)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Classifier:
    """Log odds of each domain against the last one: of the shares, and of each bucket of words."""

    def __init__(self, names: list[str], priors: list[float], weights: list[list[float]]):
        self.names, self.priors, self.weights = names, priors, weights

    def posterior(self, text: Column) -> Column:
        """``n_tokens``, and the struct ``p`` of the domains' posteriors. The text is split once, and one pass over
        its words sums up the evidence for all domains."""
        # one literal array a domain, folded from a string: a column for each number would be a huge plan
        tables = [F.split(F.lit(",".join(f"{w:.6g}" for w in weights)), ",").cast("array<double>") for weights in self.weights]
        sums = [f"s{k}" for k in range(len(tables))]
        none = F.struct(F.lit(0).alias("n"), *[F.lit(0.0).alias(s) for s in sums])

        def more(told: Column, b: Column) -> Column:
            return F.struct((told["n"] + 1).alias("n"), *[(told[s] + F.get(t, b)).alias(s) for s, t in zip(sums, tables, strict=True)])

        def odds(told: Column) -> Column:
            weight = F.least(F.lit(1.0), F.lit(STRENGTH) / F.greatest(told["n"], F.lit(1)))
            return F.array(*[F.lit(p) + told[s] * weight for p, s in zip(self.priors, sums, strict=True)], F.lit(0.0))

        buckets = F.transform(words_of(text), _bucket)
        return _bound(F.aggregate(buckets, none, more), lambda told: _bound(odds(told), lambda o: F.struct(
            told["n"].cast("bigint").alias("n_tokens"), _softmax(o, self.names).alias("p"))))


def _softmax(odds: Column, names: list[str]) -> Column:
    def shares(each: Column) -> Column:
        total = _sum([F.get(each, F.lit(k)) for k in range(len(names))])
        return F.struct(*[(F.get(each, F.lit(k)) / total).alias(name) for k, name in enumerate(names)])

    return _bound(F.array_max(odds), lambda top: _bound(F.transform(odds, lambda x: F.exp(x - top)), shares))


def fit(docs: DataFrame, labelled: DataFrame, names: list[str]) -> Classifier:
    """Learned from ``docs`` (``doc_id, text``) and ``labelled`` (``doc_id, domain``), domains in ``names``."""
    first = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("domain"))
    known = (labelled.where(F.col("domain").isin(names)).groupBy("doc_id").agg(F.min(first).alias("k"))
             .select("doc_id", (F.col("k") - 1).cast("int").alias("k")))
    counts = {r["k"]: r["count"] for r in known.groupBy("k").count().collect()}
    shares = [(counts.get(k, 0) + 1) / (sum(counts.values()) + len(names)) for k in range(len(names))]
    sample = bounded_sample(known, "doc_id", "k", dict.fromkeys(range(len(names)), PER_DOMAIN))
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = text.join(F.broadcast(sample), "doc_id").select("k", F.explode(words_of(F.col("text"))).alias("w"))
    seen = {(r["k"], r["b"]): r["count"] for r in words.groupBy("k", _bucket(F.col("w")).alias("b")).count().collect()}
    totals = [sum(c for (k, _), c in seen.items() if k == own) for own in range(len(names))]
    base = len(names) - 1
    log_share = lambda k, b: log((seen.get((k, b), 0) + 0.5) / (totals[k] + 0.5 * BUCKETS))
    weights = [[log_share(k, b) - log_share(base, b) if totals[k] and totals[base] else 0.0 for b in range(BUCKETS)] for k in range(base)]
    return Classifier(names, [log(shares[k] / shares[base]) for k in range(base)], weights)


def _dot(p: list[Column], u: list[Column]) -> Column:
    return _sum([a * b for a, b in zip(p, u, strict=True)])


def _after(p: Column, names: list[str], start: Column, steps: list[list[float]]) -> Column:
    """The pair ``r, q`` (rate, rate before) after ``steps``, from the pair ``start``. A step holds the
    gradient of each domain and, last, the momentum that it starts with."""
    # a literal once folded; steps told as one string would be parsed again for each row
    listed = F.array(*[F.array(*map(F.lit, g)) for g in steps]).cast("array<array<double>>")
    own = [p[x] for x in names]

    def step(pair: Column, u: Column) -> Column:
        down = _dot(own, [F.get(u, F.lit(k)) for k in range(len(names))])
        new = F.greatest(F.lit(0.0), pair["r"] + F.get(u, F.lit(len(names))) * (pair["r"] - pair["q"]) - down)
        return F.struct(new.alias("r"), pair["r"].alias("q"))

    return F.aggregate(listed, start, step)


def _begin() -> Column:
    return F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("q"))


def solve(mass: DataFrame, names: list[str], targets: dict[str, float], steps: int = STEPS) -> tuple[list[list[float]], dict[str, float]]:
    """The steps of accelerated projected gradient, from ``n_tokens`` and a struct ``p`` of posteriors; and the
    totals reached."""
    return _solve(mass, names, targets, steps)[:2]


def _solve(mass: DataFrame, names: list[str], targets: dict[str, float], steps: int) -> tuple[list[list[float]], dict[str, float], float]:
    """Also the largest difference left between a domain's total and its target, as a share of the domain's
    tokens at rate 1 (up to ``CLOSE``: met). Totals are linear in the rates, so those at the point ahead follow from the last two."""
    spark = mass.sparkSession
    p = [F.col(f"p.{x}") for x in names]
    base = mass.agg(F.sum("n_tokens").alias("n"), *[F.sum(F.col("n_tokens") * c).alias(f"m{k}") for k, c in enumerate(p)]).first()
    n, at_one = float(base["n"] or 0), [float(base[f"m{k}"] or 0) for k in range(len(names))]
    scale = sum(targets.get(x, 0.0) for x in names)
    goal = [n * targets.get(x, 0.0) / scale for x in names]
    pull = lambda totals: [(g - t) / m if m > 0 else 0.0 for g, t, m in zip(totals, goal, at_one, strict=True)]
    rates, pair, held, taken, fresh, t = mass, _begin(), None, [], [], 1.0
    got = before = at_one
    while len(taken) < steps and max(map(abs, pull(got)), default=0.0) > CLOSE:
        ahead = (1 + sqrt(1 + 4 * t * t)) / 2
        beta, t = (t - 1) / ahead, ahead
        step = [*pull([g + beta * (g - b) for g, b in zip(got, before, strict=True)]), beta]
        taken.append(step)
        fresh.append(step)
        now = _after(F.col("p"), names, pair, fresh)
        if len(fresh) == DEEP:
            rates, path = write_table(rates.select("n_tokens", "p", now.alias("pair")), "rates")
            now = pair = F.col("pair")
            fresh = []
            if held:
                drop_table(spark, held)
            held = path
        sums = rates.select("n_tokens", "p", now["r"].alias("r")).agg(*[F.sum(F.col("n_tokens") * c * F.col("r")).alias(f"m{k}") for k, c in enumerate(p)]).first()
        got, before = [float(sums[f"m{k}"] or 0) for k in range(len(names))], got
    if held:
        drop_table(spark, held)
    return taken, dict(zip(names, got, strict=True)), max(map(abs, pull(got)), default=0.0)


def rate_of(p: Column, names: list[str], steps: list[list[float]]) -> Column:
    """The rate after all steps, from the struct of posteriors."""
    return _after(p, names, _begin(), steps)["r"]


def copies_of(rate: Column, id_col: Column) -> Column:
    """Whole copies whose expectation over ids is the rate: the fraction is rounded by a hash of the id."""
    chance = F.pmod(F.xxhash64(id_col, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + chance).cast("bigint")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], into: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; of its columns those in ``keep``, or all) with a struct column ``into``:
    ``n_tokens``, the struct ``p`` of posteriors, ``rate``, ``copies``, and ``missed``, the same in each row: how far
    the totals end from the targets (see ``_solve``). The documents with their posteriors are written once; each
    step then reads two small columns of that table."""
    names = sorted(targets)
    text = F.col("text").cast("string")
    cols = docs.columns if keep is None else keep
    rows, _ = write_table(docs.select(*cols, fit(docs, labelled, names).posterior(text).alias(into)), "posteriors")
    steps, _, missed = _solve(rows.select(f"{into}.n_tokens", f"{into}.p"), names, targets, STEPS)
    if missed > CLOSE:
        logger.warning("the domain totals miss their targets by up to %.3g of the domain's tokens", missed)
    told = lambda rate: F.struct(
        F.col(f"{into}.n_tokens").alias("n_tokens"), F.col(f"{into}.p").alias("p"), rate.alias("rate"),
        copies_of(rate, F.col("doc_id").cast("bigint")).alias("copies"), F.lit(missed).alias("missed"))
    return rows.withColumn(into, _bound(rate_of(F.col(f"{into}.p"), names, steps), told))
