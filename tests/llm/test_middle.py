import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listenkpi.llm import middle as M


def plain(key, text):
    """Form, cuts and output by Python's own code points."""
    text = text or ""
    h = [int(hashlib.sha256(key.encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    x, y, z = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}"
    return len(text), "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}"


def test_equal_to_plain_cuts_with_a_small_memo():
    rng = random.Random(4)
    shared = ["".join(rng.choice("ab é🤦\n ") for _ in range(9000)) for _ in range(3)]
    for memo in (M.Memo(), M.Memo(2000)):
        for i in range(300):
            text = "".join(rng.choice(shared)[rng.randrange(50):] if rng.random() < 0.4 else rng.choice(["", "<", "<P", "S>", "<M>", "x" * 20_000, "word "]) for _ in range(rng.randrange(5)))
            n, form, a, b, out = M.transform(text.encode(), f"1:{i}", memo)
            assert (n, form, a, b, out.decode()) == plain(f"1:{i}", text)
    assert memo.asked > memo.found > 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM> é🤦a", max_size=60), st.integers(0, 99))
def test_markers_and_marks_across_chunks(text, key):
    ends = M.chunk_ends

    def each(data):  # chunks of a byte or two: every marker and code point spans some
        return sorted({*range(1 + key % 2, len(data), 1 + key % 2), len(data)} - {0}) if data else []

    M.chunk_ends = each
    try:
        n, form, a, b, out = M.transform(text.encode(), f"1:{key}", M.Memo())
    finally:
        M.chunk_ends = ends
    assert (n, form, a, b, out.decode()) == plain(f"1:{key}", text)


def test_chunks_follow_the_content():
    rng = random.Random(5)
    body = "".join(rng.choice("abcdefgh ") for _ in range(40_000)).encode()
    cut = lambda data: {data[a:b] for a, b in zip([0, *M.chunk_ends(data)], M.chunk_ends(data), strict=False)}
    one, two = cut(body), cut(b"another beginning of other length " + body)
    assert len(one) > 20 and len(one & two) >= len(one) - 2
    assert all(b - a <= M.LARGEST for a, b in zip([0, *M.chunk_ends(b"z" * 50_000)], M.chunk_ends(b"z" * 50_000), strict=False))


def test_rows_and_their_restored_texts(spark):
    texts = [None, "", "a", "é🤦" * 5, "with <P> inside", "long " * 100_000, "<<", "x<S", "same", "same"]
    rows = [(i if i < 9 else 8, t, "c") for i, t in enumerate(texts)] + [(None, "no id", "c")] + [(100 + i, "text number é %d" % i, "c") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n string")
    got = M.fill_in_middle(df, "fim").select("*", M.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(got) == len(rows) and {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        key = "1:" + ("" if r["doc_id"] is None else str(r["doc_id"]))
        assert tuple(r["fim"]) == plain(key, r["text"]) and r["back"] == (r["text"] or "") and r["n"] == "c"
    assert M.fill_in_middle(df.limit(0), "fim").count() == 0
