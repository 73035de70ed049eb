"""Vectorised hashes of spans in a batch of texts, and the least hash of every window.

A prefix sum of ``code(byte) * BASE**position`` modulo 2**64 gives the hash of any span in
two look-ups, so words, word windows and byte windows cost a few passes over the batch.
Equal spans always have equal hashes; callers confirm what must be exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD6E8FEB86659FD93 | 1
INVERSE = {b: pow(b, -1, 1 << 64) for b in (BASE, WORD_BASE)}
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


CODES = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=6)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**n`` modulo 2**64, computed once per size class."""
    return _powers(base, 1 << max(16, int(n).bit_length()))[: n + 1]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which :func:`spans` reads the hash of any run of ``values``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[:-1], dtype=np.uint64, out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, whatever its position."""
    return mix((sums[end] - sums[start]) * powers(INVERSE[base], len(sums) - 1)[start])


def equal_spans(sums: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every run of ``size`` values, by its start."""
    n = max(0, len(sums) - size)
    return mix((sums[size:] - sums[:n]) * powers(INVERSE[base], len(sums) - 1)[:n])


def window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each run of ``size`` values, by doubling the run that is covered."""
    out, done = values, 1
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


class Texts:
    """Some whole texts of a batch as one byte array with offsets (null: empty)."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the first word of each text (one entry more than texts).

        A word is a maximal run of bytes other than space and tab to carriage return; none
        crosses from one text to the next.
        """
        n = len(self.data)
        solid = (self.data != 32) & ((self.data < 9) | (self.data > 13))
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(n + 1, bool)
        before[1:] = solid
        after = np.zeros(n + 1, bool)
        after[:n] = solid
        start = np.flatnonzero(after & (~before | edge))
        end = np.flatnonzero(before & (~after | edge))
        return start, end, np.searchsorted(start, self.offsets)

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`words` and the hash of each word."""
        start, end, first = self.words()
        sums = prefix(CODES[self.data], BASE)
        return start, end, first, spans(sums, start, end, BASE)


def texts_of(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a string or binary column in runs of about ``limit`` bytes, no text cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Texts(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end
