"""Fill-in-middle transformation: cuts are found from the counts of content-defined chunks.

A text's bytes are cut where a rolling hash of the last ``WINDOW`` bytes has its low bits zero, so equal passages fall
into equal chunks wherever they stand. A chunk's summary is how many code points begin in it, whether it
holds a marker, and its first and last two bytes. Summaries are memoised: a chunk shared by documents is
summed up once for each worker and then looked up by its bytes, so an entry serves equal content only. Chunk
counts add up to the text's length; the cut after ``k`` code points lies in the chunk where the running count
passes ``k``, and only that chunk's bytes are looked at. A marker that spans chunks is found in the two
boundary pairs that meet.

One scan, no shuffle. The memo is bounded (``MEMO_BYTES`` of chunks, then it begins anew), as are chunks
(``LARGEST`` bytes); neither affects a result. Batches are cut by bytes, so a worker holds one long text at a time.

Form and cuts follow from the id alone: ``h1`` to ``h4``, the first four 8-digit groups of the sha256 of
``1:`` and the id.

Defined results: a NULL or empty text is ``plain`` with output ``""``, 0 units, no cuts. A text that holds a marker
stays plain. A row without id takes the hash of ``1:`` alone. Equal rows get equal outputs; texts
of any length are cut whole; an empty table gives no rows. A cut may fall at 0 or at the end, leaving empty
parts. Further columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 32
MASK = (1 << 9) - 1  # a chunk of some 512 bytes
LARGEST = 8192
MEMO_BYTES = 32 << 20
PLAIN, SPM = 90, 20  # of 100: from here on plain; below here suffix first
#: The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKERS = (PREFIX, SUFFIX, MIDDLE)
RESULT = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                       T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType())])

_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """For each byte the hash of the ``WINDOW`` bytes that end there: each one's random number, shifted by its age."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end: at content-defined places, and inside longer stretches every ``LARGEST`` bytes."""
    if not data:
        return []
    # the oldest bytes of the window stand in the high bits
    high = np.uint32(32 - MASK.bit_length())
    ends, last = [], 0
    for e in [*(np.flatnonzero(rolling(np.frombuffer(data, np.uint8)) >> high == 0) + 1).tolist(), len(data)]:
        ends += range(last + LARGEST, e, LARGEST)
        if e > last:
            ends.append(e)
            last = e
    return ends


def summary(chunk: bytes) -> tuple[int, bool, bytes, bytes]:
    """Code points that begin in the chunk, whether it holds a marker, its first and its last two bytes."""
    began = len(chunk) - int(np.count_nonzero((np.frombuffer(chunk, np.uint8) & 0xC0) == 0x80))
    return began, any(m in chunk for m in _MARKERS), chunk[:2], chunk[-2:]


class Memo:
    """Summaries by the chunks' bytes; emptied when the chunks held pass ``most`` bytes."""

    def __init__(self, most: int = MEMO_BYTES):
        self.most, self.size, self.known, self.found, self.asked = most, 0, {}, 0, 0

    def of(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        self.asked += 1
        told = self.known.get(chunk)
        if told is not None:
            self.found += 1
            return told
        if self.size + len(chunk) > self.most:
            self.known.clear()
            self.size = 0
        told = self.known[chunk] = summary(chunk)
        self.size += len(chunk)
        return told


class Counted:
    """A text by its chunks: its number of code points, whether it holds a marker, and where cuts lie."""

    def __init__(self, data: bytes, memo: Memo):
        self.data, self.ends = data, chunk_ends(data)
        total, marked, tail, counts, lo = 0, False, b"", [], 0
        for hi in self.ends:
            began, inside, head, last = memo.of(data[lo:hi])
            joint = tail + head
            marked = marked or inside or any(m in joint for m in _MARKERS)
            tail = (tail + last)[-2:] if hi - lo < 2 else last
            total += began
            counts.append(total)
            lo = hi
        self.n, self.marked, self.counts = total, marked, np.array(counts, np.int64)

    def place(self, k: int) -> int:
        """The number of bytes that the first ``k`` code points take."""
        if k >= self.n:
            return len(self.data)
        c = int(np.searchsorted(self.counts, k, "right"))  # the chunk in which code point k begins
        lo = self.ends[c - 1] if c else 0
        part = np.frombuffer(self.data, np.uint8, self.ends[c] - lo, lo)
        return lo + int(np.flatnonzero((part & 0xC0) != 0x80)[k - (int(self.counts[c - 1]) if c else 0)])


def transform(data: bytes | None, key: str, memo: Memo) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, units of prefix and middle, and output of one text, cut by the hash of ``key``."""
    data = data or b""
    text = Counted(data, memo)
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not data or text.marked or h3 % 100 >= PLAIN:
        return text.n, "plain", None, None, data
    a, b = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    i, j = text.place(a), text.place(b)
    prefix, middle, suffix = data[:i], data[i:j], data[j:]
    if h4 % 100 < SPM:
        return text.n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return text.n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


#: The memo of a Python worker: chunks are shared by the documents of all its tasks.
_MEMO = Memo()


def fill_in_middle(docs: DataFrame, into: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n, form, prefix_chars, middle_chars, output``."""
    names = [f.name for f in RESULT.fields]

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, texts in batches:
            yield pd.DataFrame([transform(t, k, _MEMO) for k, t in zip(keys, texts, strict=True)], columns=names).astype(
                {"prefix_chars": "Int64", "middle_chars": "Int64"})

    run_on = run(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.col(text_col).cast("string").cast("binary"))
    cells = F.struct(*[F.col(f"{into}.{c}").cast("string").alias(c) if c == "output" else F.col(f"{into}.{c}").alias(c) for c in names])
    return docs.withColumn(into, run_on).withColumn(into, cells)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    part = F.split(output, "<[PSM]>", -1)
    whole = lambda i: F.get(part, F.lit(i))
    return (F.when(form == "psm", F.concat(whole(1), whole(3), whole(2)))
            .when(form == "spm", F.concat(whole(2), whole(3), whole(1))).otherwise(output))
