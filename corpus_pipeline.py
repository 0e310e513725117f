"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the one before kept. All but the
last return the columns of ``documents``.

1. ``toxicity``: documents scored toxic go.
2. ``near_duplicates``: of each group linked by SimHash the document of the least id stays.
3. ``decontamination``: documents that hold benchmark passages go.
4. ``pseudonyms``: personal data in the texts is replaced; ``n_chars`` follows the new text.
5. ``mixing``: for each document its domain posteriors and rate; one row for each document kept.

Defined results: a NULL or empty text is not toxic (unless all labels are), has fingerprint zero, holds no benchmark passage, has
nothing to replace and 0 tokens; of the documents of fingerprint zero the one of the least id stays. Rows without ``doc_id``
are judged by their text and stay unless toxic or contaminated. Where one ``doc_id`` names several texts, each is judged by
itself; of rows that repeat an id and its text one stays. Texts of any length are read whole. Further columns stay, also
where they bear names that a stage uses inside; the last stage's own columns replace those of the same name. An empty table
gives an empty one. With no labels nothing is toxic and each domain's share is even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.llm import decontaminate, mixing, pii, simhash, toxicity
from listenkpi.llm.common import read, write_table
from listenkpi.llm.queries import session

#: SQL can't express training, SimHash components or keyed permutations; tests hold a plain version.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pseudonyms_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return pii.rewrite_text(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    into = "mix"
    while into in docs.columns:
        into += "_"
    labelled = mixing.domain_of_labels(read(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, labelled, mixing.TARGETS, into)
    new = {"n_tokens": F.col(f"{into}.n_tokens"), **{f"p_{x}": F.col(f"{into}.p.{x}") for x in sorted(mixing.TARGETS)},
           "rate": F.col(f"{into}.rate"), "copies": F.col(f"{into}.copies")}
    return mixed.select(*[c for c in docs.columns if c not in new], *[c.alias(name) for name, c in new.items()])


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pseudonyms", pseudonyms_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = write_table(stage(spark, docs, sf_dir), name)
    return docs
