"""Texts of an Arrow batch as flat numpy arrays: words, lines and 64-bit hashes.

A batch is cut into chunks of whole texts of at most ``CHUNK`` bytes (a longer text is a chunk
of its own), so memory follows the longest text and never the batch. NULL reads as empty.
Hashes are 64-bit polynomials over random byte values: equal strings have equal hashes, and
two of a billion different strings agree with a chance of about 3 in 100.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21

_draw = np.random.default_rng(20240229)
BYTE_VALUES = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that end a word: space and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True

#: Bytes that end a word of ASCII letters, digits and any non-ASCII characters.
SIGNS = np.ones(256, bool)
SIGNS[0x30:0x3A] = SIGNS[0x41:0x5B] = SIGNS[0x61:0x7B] = SIGNS[0x80:] = False

#: Bytes that begin a character.
LEADS = (np.arange(256) & 0xC0) != 0x80

NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _room(n: int) -> int:
    return max(CHUNK, 1 << int(n).bit_length())


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Chunk:
    """Some whole texts: ``data`` holds their bytes, text ``i`` is ``data[bounds[i]:bounds[i+1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first, self.n = data, bounds, first, len(bounds) - 1

    def spans(self, ends: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Starts and ends of the runs without bytes of ``ends``, and each text's first run (n + 1)."""
        free = ~ends[self.data] if inside is None else inside
        if not len(free):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(self.n + 1, np.int64)
        opens, shuts = free.copy(), free.copy()
        opens[1:] &= ~free[:-1]
        shuts[:-1] &= ~free[1:]
        lo, hi = self.bounds[:-1], self.bounds[1:]
        full = hi > lo
        opens[lo[full]] = free[lo[full]]
        shuts[hi[full] - 1] = free[hi[full] - 1]
        starts = np.flatnonzero(opens)
        return starts, np.flatnonzero(shuts) + 1, np.searchsorted(starts, self.bounds)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hashes of the byte runs."""
        data = LOWER[self.data] if lower else self.data
        size = _room(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * _powers(size, BASE)[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _powers(size, _INVERSE)[starts])

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sums per text of a value per byte."""
        total = np.zeros(len(per_byte) + 1, np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def chunks(column: pa.Array | pa.ChunkedArray, budget: int = CHUNK) -> Iterator[Chunk]:
    """The texts of a string column in order."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = int(np.searchsorted(offsets, offsets[at] + budget, side="right")) - 1
        upto = min(max(upto, at + 1), len(column))
        bounds = offsets[at : upto + 1]
        yield Chunk(data[bounds[0] : bounds[-1]], bounds - bounds[0], at)
        at = upto


def grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive items inside each text, and each text's first gram (n + 1).

    A text of fewer items has none.
    """
    per_text = np.maximum(np.diff(first) - (n - 1), 0)
    bounds = np.zeros(len(first), np.int64)
    np.cumsum(per_text, out=bounds[1:])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    # Position of each gram's first item: consecutive inside a text.
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], per_text)
    out = h[at]
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[at + k]
    return mix(out ^ np.uint64(n)), bounds


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]`` for each i, 0 where empty; the same items
    always give the same sum."""
    out = np.zeros(len(bounds) - 1, np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], dtype=out.dtype)
    return out
