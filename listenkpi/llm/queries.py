"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenkpi.llm import ann as N
from listenkpi.llm import decontaminate as D
from listenkpi.llm import iblt as B
from listenkpi.llm import langid as G
from listenkpi.llm import middle as C
from listenkpi.llm import mixing as M
from listenkpi.llm import negatives as H
from listenkpi.llm import pii as P
from listenkpi.llm import quality as Y
from listenkpi.llm import simhash as S
from listenkpi.llm import toxicity as X
from listenkpi.llm import warc as R
from listenkpi.llm import wrappers as W
from listenkpi.llm.common import held_out, id_text, read
from listenkpi.session import ensure_defaults

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of an Arrow batch handed to Python: bounds the text that a worker holds at once.
BATCH_ROWS = "1000"


def session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return ensure_defaults(spark)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark decontamination over all documents."""
    session(spark)
    hits = D.with_hits(id_text(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"), "hits", spans=False)
    return hits.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("hits.items").cast("array<string>")), ","), 256).alias("items_sha256"),
        D.is_contaminated("hits").alias("contaminated"),
    )


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified revisits of a crawl derived from all pages."""
    session(spark)
    found = R.resolve(R.crawl_of(read(spark, sf_dir, "pages")))
    told = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "url_key", "status", "response_id", F.array_join(told, "\n").alias("headers"), "payload_digest", "payload_length")


def op2_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and of their edited texts."""
    session(spark)
    return B.versions(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents."""
    session(spark)
    return S.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    session(spark)
    docs = id_text(read(spark, sf_dir, "documents"))
    return Y.scored(docs, read(spark, sf_dir, "labels"), "score").select(
        "doc_id", held_out("doc_id", Y.MODULUS, Y.REMAINDER).alias("held_out"), "score",
        (F.col("score") >= Y.THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    session(spark)
    docs = id_text(read(spark, sf_dir, "documents"))
    return X.scored(docs, read(spark, sf_dir, "labels"), "score").select(
        "doc_id", held_out("doc_id", X.MODULUS, X.REMAINDER).alias("held_out"), "score",
        X.rejected(F.col("score")).cast("int").alias("predicted"))


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    session(spark)
    return W.extract(read(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for the target weights of the labelled domains."""
    session(spark)
    labelled = M.domain_of_labels(read(spark, sf_dir, "labels"))
    found = M.mix(id_text(read(spark, sf_dir, "documents")), labelled, M.TARGETS, "mix", keep=["doc_id"])
    return found.select("doc_id", "mix.n_tokens", *[F.col(f"mix.p.{x}").alias(f"p_{x}") for x in sorted(M.TARGETS)], "mix.rate", "mix.copies", "mix.missed")


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced."""
    session(spark)
    docs = P.pseudonymise(id_text(read(spark, sf_dir, "documents")), "new")
    return docs.select("doc_id", "new.*")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    session(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return G.predicted(docs, "found").select(
        "doc_id", held_out("doc_id", G.MODULUS, G.REMAINDER).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), "found.score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 20th vector's 20 nearest among all vectors."""
    session(spark)
    return N.nearest(read(spark, sf_dir, "embeddings"))


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in fill-in-middle form."""
    session(spark)
    docs = C.fill_in_middle(id_text(read(spark, sf_dir, "documents")), "fim")
    told = docs.select("doc_id", "fim.*")
    return told.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(C.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each 50th vector among all vectors."""
    session(spark)
    return H.hard_negatives(read(spark, sf_dir, "embeddings"), label=H.relabelled(F.col("label"), F.col("vec_id")))


REGISTRY: dict[str, Query] = {
    "op1_revisits": op1_revisits,
    "op2_iblt": op2_iblt,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_wrappers": op6_wrappers,
    "op7_mixing": op7_mixing,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_language": op9_language,
    "op10_decontaminate": op10_decontaminate,
    "op11_neighbours": op11_neighbours,
    "op12_middle": op12_middle,
    "op13_negatives": op13_negatives,
}
