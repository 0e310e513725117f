"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of the character n-grams of its distinct words (3 to 6 bytes, word ends marked), hashed
into buckets. Each bucket has an embedding; a text is the mean of its n-grams' embeddings, with ``NEUTRAL``
n-grams of embedding zero added, so that the mean of a short text isn't ruled by one chance n-gram; a linear
softmax reads that mean. Embeddings and softmax are trained together, so an unseen spelling of a word is scored
by the n-grams it shares with known ones.

Trained on the driver on a bounded sample of labelled rows, at most ``PER_CLASS`` of each class, the
first by a hash of their id; classes weigh the same. As the mean is linear, the trained model folds into
one weight for each bucket (2 MB), which the scoring tasks carry: the cost of scoring doesn't depend on
the embedding's width, and every whole text is scored in one pass without a shuffle.

Defined results: a NULL or empty text, or one without letters and digits, has no n-gram and gets the
model's score of an empty bag, its bias. Labels that contradict each other for one id count as toxic;
NULL labels and ids are not learned from. With no labelled row of one class every score is the other
class (1.0 if only toxic rows are known, else 0.0).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.llm import ngrams
from listenkpi.llm.common import bounded_sample, fold, id_text
from listenkpi.llm.learn import labelled_bags, text_column

SIZES = (3, 4, 5, 6)
BITS = 18
WIDTH = 8
PER_CLASS = {1: 1500, 0: 3000}
MODULUS, REMAINDER = 5, 0
THRESHOLD = 0.5
NEUTRAL = 1000
EPOCHS, BATCH, RATE, SCALE = 6, 32, 0.05, 30.0


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Embeddings and softmax by minibatch Adagrad; returns the log odds that each bucket adds for a text
    that is wholly that bucket, and the bias."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.01, (1 << BITS, WIDTH)).astype(np.float32)
    soft = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    embed_sq, soft_sq, bias_sq = (np.full_like(x, 1e-8) for x in (embed, soft, bias))
    weight = (len(labels) / (2 * np.bincount(labels, minlength=2))).astype(np.float32)
    filled = np.array([i for i, (ids, _) in enumerate(bags) if len(ids)])
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(filled), max(1, len(filled) // BATCH)):
            if not len(rows):
                continue
            ids = np.concatenate([bags[i][0] for i in rows])
            share = np.concatenate([bags[i][1] for i in rows]) * np.float32(SCALE)
            sizes = np.array([len(bags[i][0]) for i in rows])
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(embed[ids] * share[:, None], starts, axis=0)
            logits = mean @ soft + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            own = labels[rows]
            error[np.arange(len(rows)), own] -= 1
            error *= (weight[own] / len(rows))[:, None]
            to_soft, to_bias = mean.T @ error, error.sum(0)
            to_rows = np.repeat(error @ soft.T, sizes, axis=0) * share[:, None]
            used, at = np.unique(ids, return_inverse=True)
            to_embed = np.stack([np.bincount(at, to_rows[:, k], len(used)) for k in range(WIDTH)], 1).astype(np.float32)
            embed_sq[used] += to_embed**2
            embed[used] -= RATE * to_embed / np.sqrt(embed_sq[used])
            soft_sq += to_soft**2
            soft -= (RATE * to_soft / np.sqrt(soft_sq)).astype(np.float32)
            bias_sq += to_bias**2
            bias -= (RATE * to_bias / np.sqrt(bias_sq)).astype(np.float32)
    return embed @ (soft[:, 1] - soft[:, 0]) * np.float32(SCALE), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The model, learned from labelled rows of ``docs`` (``doc_id, text``) outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold("doc_id", MODULUS) != REMAINDER)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = bounded_sample(known, "doc_id", "toxic", PER_CLASS)
    bags, y = labelled_bags(docs, sample, "toxic", SIZES, BITS, digits=True, distinct=True, neutral=NEUTRAL)
    if len(set(y.tolist())) < 2:
        return np.zeros(1 << BITS, np.float32), np.inf if len(y) and y[0] else -np.inf
    return train(bags, y.astype(np.int64))


def scorer(model: tuple[np.ndarray, float]):
    """A column function: the score of a text."""
    weights, bias = model[0].reshape(-1, 1), model[1]

    def score(texts: list[str]) -> np.ndarray:
        mean, _ = ngrams.means(texts, weights, SIZES, digits=True, distinct=True, neutral=NEUTRAL)
        with np.errstate(over="ignore"):  # far below 0: exactly 0
            return 1 / (1 + np.exp(-(mean[:, 0] + bias)))

    return text_column(score, T.DoubleType())


def scored(docs: DataFrame, labels: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score in the column ``into``."""
    return docs.withColumn(into, scorer(fit(id_text(docs, text_col=text_col), labels))(F.col(text_col).cast("string")))


def rejected(score: Column) -> Column:
    return score >= THRESHOLD


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored toxic; columns as they were."""
    into = "toxicity"
    while into in docs.columns:
        into += "_"
    return scored(docs, labels, into).where(~rejected(F.col(into))).drop(into)
