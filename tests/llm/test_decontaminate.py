import re

import pytest

from listenkpi.llm import decontaminate as D

WORDS = [f"w{i}" for i in range(60)]
ITEM = " ".join(WORDS[:20])


def brute(text, items, window=13):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, named = find(text), set(), set()
    for item, told in items:
        own = find(told)
        if not own:
            continue
        n = min(window, len(own))
        wins = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                named |= {item} - {None}
    return len(words), len(hit), sorted(named)


DOCS = [
    (1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "... !?"), (5, " ".join(WORDS[3:15])),
    (6, "x " * 400 + " ".join(WORDS[2:15]).upper() + " y" * 400), (7, "a, B; c"), (8, "short ITEM!"), (None, ITEM),
    (9, "é " + ITEM.replace(" ", "\n") + " ñ " + ITEM), (10, "long " * 50_000 + ITEM),
]
ITEMS = [(1, ITEM), (1, ITEM), (2, "Short item"), (3, None), (4, "?!"), (10, " ".join(WORDS[7:40])), (None, "a b c")]


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("block_chars", [D.BLOCK_CHARS, 300])
def test_hits_equal_brute_force_in_one_block_or_many(tables, block_chars):
    docs, items = tables
    got = D.with_hits(docs, items, "hits", spans=False, block_chars=block_chars).collect()
    key = lambda x: str(x)
    want = sorted(((d, *brute(t, ITEMS)) for d, t in DOCS), key=key)
    assert sorted(((r["doc_id"], r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"]) for r in got), key=key) == want


def test_spans_are_offsets_of_the_original(spark):
    text = "Ω before " + "  ".join(WORDS[:13]).upper() + ", after"
    docs, items = spark.createDataFrame([(1, text)], "doc_id bigint, text string"), spark.createDataFrame([(7, ITEM)], "item_id bigint, text string")
    hits = D.with_hits(docs, items, "hits").first()["hits"]
    assert [text[a:b] for a, b in zip(hits["starts"], hits["ends"], strict=True)] == ["  ".join(WORDS[:13]).upper()]


def test_spans_are_the_same_in_one_block_or_many(spark, tables):
    docs, items = tables
    docs = docs.withColumn("text_key", docs["doc_id"]).withColumn("hits__key", docs["text"])
    whole, cut = (sorted((str(r) for r in D.with_hits(docs, items, "hits", block_chars=n).collect())) for n in (D.BLOCK_CHARS, 100))
    assert whole == cut
    three = spark.createDataFrame([(1, "a b c"), (2, "c d e f g"), (3, "x y z")], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b, c d. e f g and then x  y z")], "doc_id bigint, text string")
    for n in (D.BLOCK_CHARS, 5):
        hits = D.with_hits(one, three, "hits", window=3, block_chars=n).first()["hits"]
        assert (hits["starts"], hits["ends"]) == ([0, 25], [15, 31])


def test_rule_and_columns_kept(spark, tables):
    docs, items = tables
    docs = docs.withColumnRenamed("doc_id", "hits").selectExpr("hits as doc_id", "text", "'x' as hits", "1 as n_words")
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    # 13 of 813 words are under one in 20; NULL and empty texts stay
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 6, 10]


def test_empty_tables(spark, tables):
    docs, items = tables
    assert D.with_hits(docs.limit(0), items, "hits").count() == 0
    assert {r["hits"]["n_hit"] for r in D.with_hits(docs, items.limit(0), "hits").collect()} == {0}
