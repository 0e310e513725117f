"""What the text classifiers share: labelled n-gram bags of a bounded sample, and scoring in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenkpi.llm import ngrams
from listenkpi.llm.common import by_slices


def labelled_bags(docs: DataFrame, sample: DataFrame, label: str, sizes: tuple[int, ...], bits: int,
                  digits: bool, distinct: bool = False, neutral: int = 0) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The n-gram bags and labels of the sampled rows, in the order of their ids. ``docs`` holds ``doc_id,
    text``; ``sample`` holds at most a stated number of ``doc_id`` and ``label`` rows, so it may be
    broadcast. Bags are made in the tasks and come to the driver packed; a bag is bounded by the buckets."""
    chosen = sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).alias("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    return collected(bags_of(rows, sizes, bits, digits, distinct, neutral))


def bags_of(rows: DataFrame, sizes: tuple[int, ...], bits: int, digits: bool, distinct: bool = False, neutral: int = 0,
            most: int | None = None) -> DataFrame:
    """``doc_id, label, ids, shares`` of each row of ``doc_id, label, text``: its n-gram bag, packed. ``most``: a bag
    keeps its largest shares only, so many (then the smaller numbers)."""
    kind = dict(rows.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_slices(batches, "text"):
            bags = [cut(*b) for b in ngrams.bags(texts, sizes, bits, digits, distinct, neutral)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("label"),
                pa.array([b.astype("<i4").tobytes() for b, _ in bags], pa.binary()),
                pa.array([s.astype("<f4").tobytes() for _, s in bags], pa.binary()),
            ], names=["doc_id", "label", "ids", "shares"])

    def cut(ids: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if most is None or len(ids) <= most:
            return ids, shares
        keep = np.sort(np.argsort(-shares, kind="stable")[:most])
        return ids[keep], shares[keep]

    return rows.mapInArrow(run, f"doc_id bigint, label {kind}, ids binary, shares binary")


def collected(packed: DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The bags and labels of a bounded number of rows, in the order of their ids."""
    found = packed.toArrow()
    # views into the collected table, so that the bags are held once
    ids, shares = _views(found["ids"], "<i4"), _views(found["shares"], "<f4")
    keys = found["doc_id"].to_pylist()
    order = sorted(range(found.num_rows), key=lambda i: (keys[i], ids[i].tobytes()))
    labels = found["label"].to_pylist()
    return [(ids[i], shares[i]) for i in order], np.array([labels[i] for i in order])


def _views(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    """The packed numbers of each row of a binary column, without a copy."""
    out = []
    for chunk in column.chunks:
        _, places, data = chunk.buffers()
        wide = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
        ends = np.frombuffer(places, wide)[chunk.offset:chunk.offset + len(chunk) + 1]
        flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        out += [flat[a:b].view(kind) for a, b in zip(ends, ends[1:], strict=False)]
    return out


def text_column(score: Callable[[list[str]], pd.DataFrame | np.ndarray], returns, most: int = 1 << 20):
    """A column function of a text column; ``score`` gets lists of texts of bounded total length (a NULL
    text comes as the empty string) and gives a row for each."""

    def run(batches):
        for texts in batches:
            values = [t or "" for t in texts]
            cuts, size = [0], 0
            for i, t in enumerate(values):
                if size and size + len(t) > most:
                    cuts.append(i)
                    size = 0
                size += len(t)
            parts = [score(values[a:b]) for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True)]
            yield pd.concat([p if isinstance(p, pd.DataFrame) else pd.Series(p) for p in parts], ignore_index=True)

    row = pd.DataFrame if isinstance(returns, T.StructType) else pd.Series
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[row]}
    return F.pandas_udf(run, returns)
