"""Language identification in two steps: the language's family, then the languages within it.

A text is the bag of the character n-grams of its words (1 to 4 bytes, word ends marked), hashed into
buckets. A linear support vector machine for each family tells it from all others, and the largest margin wins.
Then, within the predicted family, one-versus-one machines for each pair of its languages vote; ties go to the larger sum
of margins, then to the first name. All machines read the same mean over the n-grams, so a text is scored by
all of them in one pass without a shuffle.

Trained on a sample: about ``PER_LANGUAGE`` documents of each language that documents are marked with, however many
there are; of more than ``ROWS / PER_LANGUAGE`` languages about ``ROWS`` documents in all, evenly, but ``LEAST`` of each. They are
those outside the held-out fold whose id has the smallest hashes (an id counts once). A training bag
keeps its ``BAG`` largest shares. So what the driver gathers is bounded, and so is what each machine learns
from. Machines are trained in tasks, one a row. The model grows with the families and the pairs within one.

Defined results: a text that is NULL, empty or without a letter (Unicode's letter categories) is ``und`` with score 0.0, whatever is
known. A language whose code the family table lacks is a family by itself. With no labelled document
every text is ``und``; with one language every text with a letter is that one, with score 1.0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.llm import ngrams
from listenkpi.llm.common import fold
from listenkpi.llm.learn import bags_of, collected, text_column

SIZES = (1, 2, 3, 4)
BITS = 16
PER_LANGUAGE, ROWS, LEAST = 600, 16_000, 4
BAG = 2048
MODULUS, REMAINDER = 4, 2
EPOCHS, RATE, PENALTY, SCALE = 12, 0.05, 1e-5, 30.0
UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

#: Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "uralic": ["et", "fi", "hu", "se"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "semitic": ["am", "ar", "he", "mt"],
    "celtic": ["br", "cy", "ga", "gd"],
    "baltic": ["lt", "lv"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def machine(bags: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, seed: int = 0) -> np.ndarray:
    """A linear support vector machine: hinge loss with an L2 penalty by minibatch Adagrad. The weights,
    and at the end the bias."""
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(1 << BITS), 0.0
    squares, bias_sq = np.full(1 << BITS, 1e-8), 1e-8
    each = len(signs) / (2 * np.array([max(1, (signs < 0).sum()), max(1, (signs > 0).sum())]))
    filled = np.array([i for i, (ids, _) in enumerate(bags) if len(ids)], dtype=np.int64)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(filled), max(1, min(75, len(filled) // 16))):
            if not len(rows):
                continue
            ids = np.concatenate([bags[i][0] for i in rows])
            share = np.concatenate([bags[i][1] for i in rows]) * SCALE
            sizes = np.array([len(bags[i][0]) for i in rows])
            y = signs[rows]
            margin = y * (np.add.reduceat(weights[ids] * share, np.cumsum(sizes) - sizes) + bias)
            pull = np.where(margin < 1, -y * each[(y > 0).astype(int)] / len(rows), 0.0)
            slope = np.bincount(ids, np.repeat(pull, sizes) * share, 1 << BITS) + PENALTY * weights
            squares += slope**2
            weights -= RATE * slope / np.sqrt(squares)
            bias_sq += pull.sum() ** 2
            bias -= RATE * pull.sum() / np.sqrt(bias_sq)
    return np.append(weights * SCALE, bias)


class Model:
    """``groups``: the families' names under ``None``, the languages under each family's name. A column of
    ``weights`` for each machine, listed in ``pairs``: ``(None, f, -1)`` for family ``f`` against the others, ``(family, a, b)``
    for a pair of its languages; positive for the first. Two families need one machine."""

    def __init__(self, groups: dict[str | None, list[str]], pairs: list[tuple[str | None, int, int]], weights: np.ndarray,
                 biases: np.ndarray):
        self.groups, self.pairs, self.weights, self.biases = groups, pairs, weights, biases

    def choose(self, group: str | None, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the winner's number within the group, and its smallest margin over the others."""
        n = len(self.groups[group])
        own = [c for c, (g, _, b) in enumerate(self.pairs) if g is None and b < 0]
        if group is None and own:
            each = margins[:, own]
            best = each.argmax(1)
            second = np.partition(each, -2, axis=1)[:, -2]
            return best, (each.max(1) - second) / 2
        votes, total = np.zeros((len(margins), n)), np.zeros((len(margins), n))
        least = np.full((len(margins), n), np.inf)
        for c, (g, a, b) in enumerate(self.pairs):
            if g != group:
                continue
            m = margins[:, c]
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            for k, towards in ((a, m), (b, -m)):
                total[:, k] += towards
                least[:, k] = np.minimum(least[:, k], towards)
        best = (votes == votes.max(1, keepdims=True))
        best = np.where(best, total, -np.inf).argmax(1)
        return best, least[np.arange(len(margins)), best]

    def predict(self, texts: list[str]) -> pd.DataFrame:
        langs = np.full(len(texts), UNKNOWN, dtype=object)
        scores = np.zeros(len(texts))
        known = np.array([i for i, t in enumerate(texts) if self.groups and _LETTER.search(t)], dtype=np.int64)
        if len(known):
            if self.pairs:
                means, _ = ngrams.means([texts[i] for i in known], self.weights, SIZES, digits=False)
                margins = means + self.biases
            else:
                margins = np.zeros((len(known), 0))
            family, far = self.choose(None, margins)
            for f, name in enumerate(self.groups[None]):
                own = np.flatnonzero(family == f)
                if len(own):
                    lang, near = self.choose(name, margins[own])
                    langs[known[own]] = np.array(self.groups[name], dtype=object)[lang]
                    with np.errstate(over="ignore"):
                        scores[known[own]] = 1 / (1 + np.exp(-2 * np.minimum(far[own], near)))
        return pd.DataFrame({"lang": langs, "score": scores})


def _sample(docs: DataFrame) -> DataFrame:
    """``doc_id, label, text`` of the training documents. A language's share of documents is kept by a bound on the
    hash of their ids, so one scan finds them; only the languages and their counts come to the driver."""
    known = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("label"), F.col("text").cast("string").alias("text"))
             .where("label IS NOT NULL AND doc_id IS NOT NULL").where(fold("doc_id", MODULUS) != REMAINDER))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    each = min(PER_LANGUAGE, max(LEAST, ROWS // max(1, len(counts))))
    bounds = [(lang, min(1.0, each / n)) for lang, n in sorted(counts.items())]
    told = known.sparkSession.createDataFrame(bounds, "label string, most double")  # a row for each language
    place = (F.xxhash64(F.col("doc_id").cast("string")).cast("double") + 2.0**63) / 2.0**64
    return known.join(F.broadcast(told), "label").where((place < F.col("most")) | (F.col("most") == 1)).select("doc_id", "label", "text")


def _trained(docs: DataFrame, bags: list, y: np.ndarray, families: np.ndarray, groups: dict, pairs: list) -> np.ndarray:
    """The machines' weights and biases, a column for each pair, each trained in a task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((bags, y, families))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in batch.column("id").to_pylist():
                bags, y, families = shared.value
                group, a, b = pairs[c]
                of, names = (families, groups[None]) if group is None else (y, groups[group])
                rows = np.flatnonzero((of == names[a]) | (of == names[b])) if b >= 0 else np.arange(len(of))
                found = machine([bags[i] for i in rows], np.where(of[rows] == names[a], 1.0, -1.0))
                yield pa.RecordBatch.from_pydict({"id": pa.array([c], pa.int64()), "w": pa.array([found.astype("<f4").tobytes()], pa.binary())})

    rows = spark.range(len(pairs)).repartitionById(max(1, len(pairs)), F.col("id").cast("int"))
    columns = {r["id"]: np.frombuffer(r["w"], "<f4") for r in rows.mapInArrow(run, "id bigint, w binary").collect()}
    shared.unpersist()
    return np.stack([columns[c] for c in range(len(pairs))], 1) if pairs else np.zeros(((1 << BITS) + 1, 0), np.float32)


def fit(docs: DataFrame) -> Model:
    """The model, learned from ``doc_id, text, lang`` outside the held-out fold."""
    packed = bags_of(_sample(docs), SIZES, BITS, digits=False, most=BAG)
    # rows that repeat an id and its language count once, whatever the number of copies
    once = packed.groupBy("doc_id", "label").agg(F.min(F.struct("ids", "shares")).alias("bag")).select("doc_id", "label", "bag.ids", "bag.shares")
    bags, y = collected(once)
    langs = sorted(set(y.tolist()))
    if not langs:
        return Model({}, [], np.zeros((0, 0)), np.zeros(0))
    groups: dict[str | None, list[str]] = {None: sorted({family_of(x) for x in langs})}
    for name in groups[None]:
        groups[name] = [x for x in langs if family_of(x) == name]
    families = np.array([family_of(x) for x in y], dtype=object)
    pairs = [(name, a, b) for name in groups[None] for a, b in combinations(range(len(groups[name])), 2)]
    n = len(groups[None])
    pairs = ([(None, 0, 1)] if n == 2 else [(None, f, -1) for f in range(n)] if n > 2 else []) + pairs
    found = _trained(docs, bags, y.astype(object), families, groups, pairs)
    return Model(groups, pairs, found[:-1], found[-1].astype(np.float64))


def predicted(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` (``doc_id, text, lang`` at least) with a struct column ``into`` of ``lang, score``."""
    return docs.withColumn(into, text_column(fit(docs).predict, RESULT)(F.col("text").cast("string")))
