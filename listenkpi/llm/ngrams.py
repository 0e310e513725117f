"""Hashed character n-grams of many texts at once, in numpy: the features of two of the classifiers.

A text is lower-cased, everything but letters (and digits, if asked) becomes one space, and each word
keeps a space at either end, so an n-gram knows where a word begins and ends. N-grams are taken over
UTF-8 bytes inside one word and hashed into ``2 ** bits`` buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_DIGITS_TOO = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def folded(texts: list[str], digits: bool, distinct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (one more: the end). With
    ``distinct`` a word counts once in a text."""
    table = _DIGITS_TOO if digits else _LETTERS
    parts = []
    for t in texts:
        words = t.lower().encode("utf-8", "surrogatepass").translate(table).split()
        words = list(dict.fromkeys(words)) if distinct else words
        parts.append(b" " + b" ".join(words) + b" " if words else b"")
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), ends


def buckets(data: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n of ``sizes`` (ascending): positions where an n-gram begins, and its bucket there."""
    wide = data.astype(np.uint32)
    space = data == 32
    before = np.concatenate([[0], np.cumsum(space, dtype=np.int64)])
    h = np.full(len(data), 0x811C9DC5, np.uint32)
    for n in range(1, max(sizes) + 1):
        m = len(data) - n + 1
        if m <= 0:
            return
        h = (h[:m] ^ wide[n - 1:]) * np.uint32(0x01000193)
        if n not in sizes:
            continue
        if n == 1:
            ok = ~space
        elif n == 2:
            ok = ~(space[:m] & space[1:])
        else:
            ok = before[n - 1:n - 1 + m] == before[1:1 + m]
        at = np.flatnonzero(ok)
        own = h[at]
        own ^= own >> np.uint32(15)
        own *= np.uint32(0x2C1B3C6D)
        yield at, (own >> np.uint32(32 - bits)).astype(np.int64)


def bags(texts: list[str], sizes: tuple[int, ...], bits: int, digits: bool, distinct: bool = False,
         neutral: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares of its n-grams and of ``neutral`` ones more, which
    no bucket has."""
    for t in texts:
        data, _ = folded([t], digits, distinct)
        ids = [b for _, b in buckets(data, sizes, bits)] if len(data) else []
        if not ids or not sum(map(len, ids)):
            yield np.zeros(0, np.int64), np.zeros(0, np.float32)
            continue
        found, n = np.unique(np.concatenate(ids), return_counts=True)
        yield found, (n / (n.sum() + neutral)).astype(np.float32)


def means(texts: list[str], weights: np.ndarray, sizes: tuple[int, ...], digits: bool, distinct: bool = False,
          neutral: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each text the mean of the rows of ``weights`` (buckets x k) over its n-grams and ``neutral`` ones of
    weight 0 more, and whether it has any n-gram."""
    bits = int(weights.shape[0]).bit_length() - 1
    data, ends = folded(texts, digits, distinct)
    total = np.zeros((len(texts), weights.shape[1]))
    count = np.zeros(len(texts), np.int64)
    have = np.flatnonzero(np.diff(ends))
    if len(have):
        starts = ends[have]
        for at, ids in buckets(data, sizes, bits):
            cut = np.searchsorted(at, np.append(starts, ends[-1]))
            n = np.diff(cut)
            some = np.flatnonzero(n)
            count[have] += n
            for k in range(weights.shape[1]):
                if len(some):
                    total[have[some], k] += np.add.reduceat(weights[ids, k], cut[some])
    return total / np.maximum(count + neutral, 1)[:, None], count > 0
