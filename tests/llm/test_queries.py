"""The registered queries: SQL twins, contract columns, and that the rest works without this folder."""

import importlib.util
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF0001
from oracle_harness import compare, duck

import __spark_entry__ as E
from listenkpi.llm import queries as Q
from listenkpi.llm.oracle import ORACLE
from listenkpi.plans import inspect

COLUMNS = {
    "op1_revisits": ["record_id", "url_key", "status", "response_id", "headers", "payload_digest", "payload_length"],
    "op2_iblt": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_quality": ["doc_id", "held_out", "score", "predicted"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_wrappers": ["page_id", "url", "text", "n_chars"],
    "op7_mixing": ["doc_id", "n_tokens", "rate", "copies"],
    "op8_pseudonyms": ["doc_id", "text"],
    "op9_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op11_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op12_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


def test_all_are_registered():
    assert set(COLUMNS) == set(Q.REGISTRY) and {*COLUMNS, "pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    res = compare(spark, SF0001, name, Q.REGISTRY[name], ORACLE[name], duck(SF0001), verbose=False)
    assert res["status"] == "match", res


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLE)))
def test_one_row_for_each_row_of_the_table(spark, name):
    out = Q.REGISTRY[name](spark, SF0001)
    key = "page_id" if name == "op6_wrappers" else "doc_id"
    table = spark.read.parquet(f"{SF0001}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert [c for c in COLUMNS[name] if c not in out.columns] == []
    assert sorted(r[key] for r in out.select(key).collect()) == sorted(r[key] for r in table.select(key).collect())
    if name == "op7_mixing":
        assert inspect.python_nodes(out) == []


def test_the_rest_works_without_these_folders(tmp_path):
    top = Path(importlib.util.find_spec("__spark_entry__").origin).parent
    for p in [*top.glob("*.py"), *top.glob("listenkpi/**/*.py")]:
        part = p.relative_to(top)
        if "llm" not in part.parts and part.name != "corpus_pipeline.py":
            (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / part).write_text(p.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(x.startswith('op') for x in q) and set(q) == set(e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
