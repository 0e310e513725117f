"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark items.

Words are the runs of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters. Every item
gives its windows of 13 consecutive words (a shorter item is one window). All distinct windows go into
one automaton; each text is normalised to single-spaced words and scanned once, so the cost doesn't
depend on the number of windows. A match is mapped back to word numbers, and those to character
offsets of the original text.

The windows are a stated test set that every task needs. Their size is measured before they are
broadcast: up to ``block_chars`` characters they are one automaton; beyond it they are cut into blocks
of that size by their hash, and the texts are scanned once per block and the hits merged, so an
executor never holds more than one block.

Defined results: NULL text or text without words: 0 words, 0 hits, not contaminated. NULL items and
items without words give no window. An item repeated under one id counts once; an item without id
marks words but is not listed. Repeated documents each get their own row.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
RATIO = 20  # contaminated: at least one word in 20 is hit
BLOCK_CHARS = 2_000_000

#: What is not part of a word becomes a space, A-Z become a-z; bytes of non-ASCII characters stay.
_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
#: A word in a text whose letters A-Z aren't lower-cased yet.
WORD_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_INTS = T.ArrayType(T.IntegerType())
HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                     T.StructField("items", T.ArrayType(T.LongType())), T.StructField("starts", _INTS),
                     T.StructField("ends", _INTS), T.StructField("words", _INTS)])


def normalise(text: str | None) -> str:
    """Lower-cased words, each between single spaces, one character per UTF-8 byte (``""``: no word)."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""


@F.pandas_udf(T.ArrayType(T.StringType()))
def windows_of(texts: pd.Series, width: pd.Series) -> pd.Series:
    """The windows of each item, normalised."""
    out = []
    for text, w in zip(texts, width, strict=True):
        words = normalise(text).split()
        out.append([" " + " ".join(words[i:i + w]) + " " for i in range(max(1, len(words) - w + 1))] if words else [])
    return pd.Series(out)


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``win string, items array<bigint>``: each distinct window with the ids of the items that hold it."""
    rows = items.select(F.col(id_col).cast("bigint").alias("item"),
                        F.explode(windows_of(F.col(text_col).cast("string"), F.lit(window))).alias("win"))
    return rows.groupBy("win").agg(F.collect_set("item").alias("items"))


#: The automaton of a Python worker, under its block's name; one at a time.
_BUILT: dict[str, object] = {}


def _automaton(name: str, windows):
    import ahocorasick

    if name not in _BUILT:
        found = ahocorasick.Automaton()
        for win, ids in windows.value:
            found.add_word(win, (win.count(" ") - 1, ids))
        if len(found):
            found.make_automaton()
        _BUILT.clear()
        _BUILT[name] = found
    return _BUILT[name]


def _spans(text: str, hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Character offsets in the original of each run of hit words."""
    starts, ends, last = [], [], -2
    at = set(hit.tolist())
    for k, m in enumerate(re.finditer(WORD_ANY_CASE, text)):
        if k in at:
            if k == last + 1:
                ends[-1] = m.end()
            else:
                starts.append(m.start())
                ends.append(m.end())
            last = k
    return starts, ends


@F.pandas_udf(T.StructType([T.StructField("starts", _INTS), T.StructField("ends", _INTS)]))
def spans_of(texts: pd.Series, words: pd.Series) -> pd.DataFrame:
    """The character offsets of the runs of hit ``words`` of each text."""
    found = [_spans(t or "", np.asarray(w)) if w is not None and len(w) else ([], []) for t, w in zip(texts, words, strict=True)]
    return pd.DataFrame(found, columns=["starts", "ends"])


def _scan(text: str | None, found, spans: bool) -> tuple:
    norm = normalise(text)
    matches = list(found.iter(norm)) if norm and len(found) else ()
    if not matches:
        return max(0, norm.count(" ") - 1), 0, [], [], [], []
    spaces = np.flatnonzero(np.frombuffer(norm.encode("latin-1"), np.uint8) == 32)
    cover, ids = np.zeros(len(spaces), np.int32), set()
    for end, (width, items) in matches:
        j = int(np.searchsorted(spaces, end))  # the space after the window's last word
        cover[j - width] += 1
        cover[j] -= 1
        ids.update(items)
    hit = np.flatnonzero(np.cumsum(cover) > 0)
    starts, ends = _spans(text, hit) if spans else ([], [])
    return len(spaces) - 1, len(hit), sorted(ids), starts, ends, hit.tolist()


def scanner(windows, spans: bool):
    """A column function: the hits of a text against one broadcast block of windows."""
    name = uuid.uuid4().hex

    @F.pandas_udf(HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = _automaton(name, windows)
        for texts in batches:
            yield pd.DataFrame([_scan(t, found, spans) for t in texts],
                               columns=["n_words", "n_hit", "items", "starts", "ends", "words"])

    return scan


def blocks_of(items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS, id_col: str = "item_id",
              text_col: str = "text") -> list:
    """The windows, broadcast in blocks of about ``block_chars`` characters."""
    wins = item_windows(items, window, id_col, text_col)
    size = wins.agg(F.sum(F.length("win")).alias("n")).first()["n"] or 0
    n = -(-size // block_chars) or 1
    sc = items.sparkSession.sparkContext
    part = F.pmod(F.xxhash64("win"), F.lit(n))
    return [sc.broadcast([(r["win"], r["items"]) for r in wins.where(part == b).collect()]) for b in range(n)]


def with_hits(docs: DataFrame, items: DataFrame, into: str, window: int = WINDOW, text_col: str = "text",
              spans: bool = True, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``n_hit``, ``items``, the character spans
    ``starts``/``ends`` of the runs of hit words and the numbers of the hit ``words``. With one block the
    texts aren't shuffled. With several, each block is a scan of its own, and its hits, which depend on the
    text alone, come back by the text's digest; the runs are those of all blocks' hits together."""
    blocks = blocks_of(items, window, block_chars)
    text = F.col(text_col).cast("string")
    if len(blocks) == 1:
        return docs.withColumn(into, scanner(blocks[0], spans)(text))
    key = "text_key"
    while any(c.startswith(key) for c in [into, *docs.columns]):
        key += "_"
    told, runs = f"{key}_hits", f"{key}_runs"
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    parts = [docs.select(digest.alias(key), scanner(b, False)(text).alias("h")).where("h.n_hit > 0") for b in blocks]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    flat = lambda f: F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"h.{f}")))).alias(f)
    found = found.groupBy(key).agg(F.struct(flat("items"), flat("words")).alias(told))
    of = lambda c, kind: F.coalesce(F.col(c), F.array().cast(f"array<{kind}>"))
    words = of(f"{told}.words", "int")
    joined = docs.withColumn(key, digest).join(found, key, "left")
    joined = joined.withColumn(runs, spans_of(text, words) if spans else F.lit(None).cast("struct<starts:array<int>,ends:array<int>>"))
    hits = F.struct(F.coalesce(F.regexp_count(text, F.lit(WORD_ANY_CASE)), F.lit(0)).cast("bigint").alias("n_words"),
                    F.size(words).cast("bigint").alias("n_hit"), of(f"{told}.items", "bigint").alias("items"),
                    of(f"{runs}.starts", "int").alias("starts"), of(f"{runs}.ends", "int").alias("ends"), words.alias("words"))
    return joined.select(*[c for c in docs.columns if c != into], hits.alias(into))


def is_contaminated(hits: str) -> Column:
    """At least one word in ``RATIO`` lies inside a window."""
    return (F.col(f"{hits}.n_hit") > 0) & (RATIO * F.col(f"{hits}.n_hit") >= F.col(f"{hits}.n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows; columns as they were."""
    into = "hits"
    while into in docs.columns:
        into += "_"
    return with_hits(docs, items, into, window, spans=False).where(~is_contaminated(into)).drop(into)
