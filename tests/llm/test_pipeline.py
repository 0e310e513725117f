import corpus_pipeline as P
from pyspark.sql import functions as F

from listenkpi.llm import decontaminate, pii, simhash, toxicity
from listenkpi.llm.common import id_text, read

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    ids = {}
    for name, stage in P.STAGES:
        before = docs
        docs, _ = P.write_table(stage(spark, docs, SF), name)
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "mixing":
            assert docs.columns == columns
        if name == "toxicity":
            scores = toxicity.scored(id_text(before), read(spark, SF, "labels"), "s")
            assert ids[name] == {r["doc_id"] for r in scores.where("s < 0.5").collect()}
        if name == "near_duplicates":
            assert ids[name] == {r["component_id"] for r in simhash.near_duplicates(before).collect()}
        if name == "decontamination":
            hits = decontaminate.with_hits(id_text(before), read(spark, SF, "benchmark"), "h", spans=False)
            assert ids[name] == {r["doc_id"] for r in hits.where(~decontaminate.is_contaminated("h")).collect()}
        if name == "pseudonyms":
            told = {r["doc_id"]: r for r in docs.collect()}
            for r in before.collect():
                text, _ = pii.rewrite(r["text"])
                assert told[r["doc_id"]]["text"] == text and told[r["doc_id"]]["n_chars"] == len(text)
    assert ids["mixing"] == ids["pseudonyms"] == ids["decontamination"] and ids["mixing"]
    assert {"rate", "copies", "n_tokens"} <= set(docs.columns)


def test_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id at all", "en", "s", 12), (3, "word " * 30_000, "en", "s", 150_000),
            (4, "the same row", "en", "s", 12), (4, "the same row", "en", "s", 12)]
    docs = spark.createDataFrame(rows, read(spark, SF, "documents").schema).withColumn("hits", F.lit(1)).withColumn("mix", F.lit("m"))
    for name, stage in P.STAGES:
        docs, _ = P.write_table(stage(spark, docs, SF), name)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == sorted([1, 3, 4, None], key=str)
