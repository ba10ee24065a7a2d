"""Vectorised word splitting and rolling hashes over Arrow string buffers.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  A word's
hash is a polynomial over its bytes, a window's hash a polynomial over the
hashes of its words (both modulo 2**64, taken as differences of prefix sums,
so any window costs the same), each finished with a bijective mixer.  All
arithmetic is on ``uint64`` arrays that wrap around, so hashes agree between
batches, tasks and machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_WORD_BASE = np.uint64(0xD1342543DE82EF95)
CHUNK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


class _Powers:
    """Powers of a base and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = int(base)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, m, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows, about ``limit``
    bytes at a time (one longer text makes one longer chunk).  Null: empty."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for part in parts:
        part = pc.fill_null(part, "").cast(pa.large_string())
        n = len(part)
        if n:
            _, offsets, data = part.buffers()
            offs = np.frombuffer(offsets, dtype=np.int64)[part.offset:part.offset + n + 1]
            raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            i = 0
            while i < n:
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
                yield base + i, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                i = j
        base += n


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each row
    (one entry more than rows).  ``space`` says which bytes part words."""
    n = len(data)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offs), dtype=np.int64)
    word = ~space[data]
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~word[:-1]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    before[edge] = True
    starts = np.flatnonzero(word & before)
    after = np.empty(n, dtype=bool)
    after[:-1], after[-1] = ~word[1:], True
    after[edge - 1] = True
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offs, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _BYTES.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:-1], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive entries (row borders are ignored)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _WORDS.get(len(words))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up, out=total[1:])
    return mix64((total[width:] - total[:n]) * down[:n] + np.uint64(width))


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window that lies in one row, and that row."""
    counts = np.maximum(np.diff(first) - (width - 1), 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][rows]
    return at, rows
