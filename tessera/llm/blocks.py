"""Sorted 64-bit hashes, with numbers beside them, as compressed blocks of
buckets.  Buckets are equal ranges of hash values, a power of two of them, so a
hash's bucket is its leading bits."""

from __future__ import annotations

import functools

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Byte planes of 8-byte values, compressed: sorted hashes share their
    leading bytes, and small numbers their upper ones."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(block: bytes, n_arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), dtype=np.uint8)
    return [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in raw.reshape(n_arrays, 8, -1)]


@functools.lru_cache(maxsize=4)
def _borders(bits: int) -> np.ndarray:
    """The least hash of every bucket but the first, made once a worker."""
    return np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)


def edges(ordered: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the ``2**bits`` buckets in sorted hashes."""
    return np.concatenate([[0], np.searchsorted(ordered, _borders(bits), "left"), [len(ordered)]])


def bucket_bits(n_buckets: int) -> int:
    """Leading bits that give at least ``n_buckets`` buckets."""
    return max(0, int(n_buckets - 1).bit_length())


def bits_at(places: np.ndarray, size: int) -> bytes:
    """A compressed bitmap of ``size`` bits with those at ``places`` set."""
    flags = np.zeros(size, dtype=bool)
    flags[places] = True
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags, bitorder="little").tobytes())


def bits_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)


def interleaved(*bitmaps: np.ndarray) -> np.ndarray:
    """Up to four bitmaps of one size as an array of 32-bit numbers, a byte of each:
    one look tells what all of them say of a hash."""
    out = np.zeros(len(bitmaps[0]), np.uint32)
    for k, bitmap in enumerate(bitmaps):
        out |= bitmap.astype(np.uint32) << np.uint32(8 * k)
    return out


def look_up(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash a number whose bits 0, 8, 16 and 24 say whether its bit (of its
    leading bits) is set in the first to fourth bitmap."""
    at = (hashes >> np.uint64(64 - (8 * len(marks)).bit_length() + 1)).astype(np.uint32)
    return marks[at >> np.uint32(3)] >> (at & np.uint32(7))


def merged(ordered: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of some sorted runs, and the sums of their counts (a
    stable sort finds the runs and merges them)."""
    hashes, count = np.concatenate(ordered), np.concatenate(counts)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    heads = np.flatnonzero(new)
    return hashes[heads], np.add.reduceat(count[order], heads) if len(heads) else count
