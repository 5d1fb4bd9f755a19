"""Vectorised work on the words and bytes of whole Arrow batches of texts.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D, within one text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = x.astype(U, copy=True)
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
        return x


with np.errstate(over="ignore"):
    BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            with np.errstate(over="ignore"):
                self.up, self.down = (np.concatenate([np.ones(1, U), np.cumprod(np.full(size - 1, b, U), dtype=U)]) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_OF_BYTES, _OF_WORDS = _Powers(0x5851F42D4C957F2D | 3), _Powers(0xD1342543DE82EF95 | 3)


def _prefix(values: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[: len(values)], out=total[1:])
    return total, down


def grams(values: np.ndarray, n: int, powers: _Powers = _OF_WORDS) -> np.ndarray:
    """A hash of every n consecutive values."""
    if len(values) < n:
        return np.zeros(0, U)
    total, down = _prefix(values, powers)
    with np.errstate(over="ignore"):
        return mix((total[n:] - total[:-n]) * down[: len(values) - n + 1])


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    return grams(BYTE[data], n, _OF_BYTES)


def slide_min(a: np.ndarray, n: int) -> np.ndarray:
    """The least of every n consecutive values."""
    if len(a) < n:
        return a[:0]
    out, have = a, 1
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: -(n - have)], out[n - have :]) if have < n else out


class Piece(NamedTuple):
    lo: int  # the texts' numbers in the batch
    hi: int
    data: np.ndarray  # their bytes
    at: np.ndarray  # where each begins, and the end


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """Runs of whole texts; null is an empty text."""
    column = column.fill_null("").cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1)
        yield Piece(lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


class Words(NamedTuple):
    start: np.ndarray  # of each word, in bytes
    end: np.ndarray
    doc: np.ndarray  # number of its text in the piece
    first: np.ndarray  # number of each text's first word, and the count of all


def words(p: Piece) -> Words:
    n = len(p.data)
    separator = SEPARATOR[p.data]
    edge = np.zeros(n + 1, bool)
    edge[p.at] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    if n:
        before[1:] = separator[:-1]
        after[:-1] = separator[1:]
    start = np.flatnonzero(~separator & (before | edge[:-1]))
    end = np.flatnonzero(~separator & (after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(p.at, start, "right") - 1, np.searchsorted(start, p.at))


def hashes(p: Piece, w: Words, lower: bool = False) -> np.ndarray:
    """A hash of each word."""
    total, down = _prefix(BYTE[LOWER[p.data] if lower else p.data], _OF_BYTES)
    with np.errstate(over="ignore"):
        return mix((total[w.end] - total[w.start]) * down[w.start])


def per_doc(w: Words, values: np.ndarray) -> list[np.ndarray]:
    """The values of each text's words."""
    return np.split(values, w.first[1:-1]) if len(w.first) > 2 else [values]


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """The distinct n-word shingles of one text's word hashes, sorted; of a shorter text the whole is one."""
    if len(h) == 0:
        return np.zeros(0, U)
    return np.unique(grams(h, n) if len(h) >= n else mix(grams(h, len(h)) + U(len(h))))
