"""Substring deduplication by Rabin-Karp hashes of fixed-length word windows.

Every window of ``width`` words gets a rolling 64-bit hash.  A window goes if
the same words also start in a document with a smaller id; the words of all
removed windows merge into maximal removal intervals.

Spark does the work in three shuffles:

1. whole texts, once, into groups of a bounded number of characters;
2. per group one sorted, compressed block of ``(hash, smallest doc_id)`` for
   each hash bucket.  A hash occurs once in a block however often the group
   repeats it, so a passage that a third of all documents share adds one entry
   for each group, not one for each copy;
3. one bit for each entry back to the group: does another group hold the
   window in a smaller document?

The groups are read a second time with these bits, and each text is cut where
it lies.  Memory of a task: one group, or one hash bucket (``bucket_chars``).

Two different windows count as equal if their 64-bit hashes agree: among n
windows that takes about n*n / 2**65 accidents (0.0005 for 10**8 windows).

Defined cases: a null text has no words; a text with fewer than ``width``
words keeps all of them; a null ``doc_id`` is neither smaller nor larger than
any id, so such rows stay whole and remove nothing; rows that share a
``doc_id`` do not remove each other; equal rows give equal results, one each.
Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import sizing, wordhash
from tessera.llm.blocks import pack, unpack

WIDTH = 13
#: Text of a group: at least the first, and an even share for ``GROUPS`` groups up to
#: the second, so that blocks (groups times buckets) do not become tiny as texts grow.
GROUP_CHARS, MOST_GROUP_CHARS = 4 << 20, 32 << 20
GROUPS = 20_000
BUCKET_CHARS = 8 << 20


def _group_windows(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word (in its row) of each window of a group, for
    rows that have an id."""
    known = table.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    hashes, rows, firsts = [], [], []
    for row, data, offs in wordhash.text_chunks(table.column("text")):
        starts, ends, first = wordhash.word_spans(data, offs)
        at, in_row = wordhash.windows(first, width)
        take = known[row + in_row]
        at, in_row = at[take], in_row[take]
        if len(at):
            hashes.append(wordhash.window_hashes(wordhash.word_hashes(data, starts, ends), width)[at])
            rows.append((in_row + row).astype(np.int32))
            firsts.append((at - first[in_row]).astype(np.int32))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(hashes), np.concatenate(rows), np.concatenate(firsts)


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the smallest id of each, and each entry's place among them."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.empty(len(ordered), dtype=bool)
    new[:1], new[1:] = True, ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(new)
    place = np.empty(len(ordered), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[heads], np.minimum.reduceat(ids[order], heads) if len(heads) else ids[:0], place


@functools.lru_cache(maxsize=2)
def _cuts(n_buckets: int) -> np.ndarray:
    """The least hash of every bucket (equal ranges of hash values) but the first,
    found once a worker."""
    return np.array([((b << 64) + n_buckets - 1) // n_buckets for b in range(1, n_buckets)], dtype=np.uint64)


def _bucket_edges(distinct: np.ndarray, n_buckets: int) -> np.ndarray:
    """Borders of the buckets in sorted hashes."""
    return np.concatenate([[0], np.searchsorted(distinct, _cuts(n_buckets), "left"), [len(distinct)]])


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(0).to_numpy().astype(np.int64)


def _in_groups(docs: DataFrame, n_groups: int) -> DataFrame:
    """``grp, doc_id, text``: rows equal in id and text are told apart by their
    place in the scan."""
    return docs.select(
        sizing.bucket_of(n_groups, "doc_id", "text", F.monotonically_increasing_id()).alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )


def dedup_passages(docs: DataFrame, width: int = WIDTH, group_chars: int | None = None, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, removed`` for each row of
    ``docs``: the kept words joined by one space, and the removal intervals
    ``[start, end)`` in words, in order and not touching each other."""
    spark = docs.sparkSession
    sizing.bound_arrow(spark)
    chars = sizing.total_chars(docs)
    n_groups = max(1, -(-chars // (group_chars or max(GROUP_CHARS, min(MOST_GROUP_CHARS, chars // GROUPS)))))
    n_buckets = max(sizing.shuffle_partitions(spark), -(-chars // bucket_chars))
    grouped = _in_groups(docs, n_groups).repartition("grp")

    def blocks(key, table):
        hashes, rows, _ = _group_windows(table, width)
        distinct, least, _ = _smallest(hashes, _ids(table)[rows])
        edges = _bucket_edges(distinct, n_buckets)
        full = np.flatnonzero(np.diff(edges))
        return pa.table({
            "grp": pa.array([key[0].as_py()] * len(full), pa.int32()),
            "bucket": pa.array(full, pa.int32()),
            "block": pa.array([pack(distinct[edges[b]:edges[b + 1]], least[edges[b]:edges[b + 1]]) for b in full], pa.binary()),
        })

    def verdicts(key, table):
        parts = [unpack(b, 2) for b in table.column("block").to_pylist()]
        hashes = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1] for p in parts]).view(np.int64)
        _, least, place = _smallest(hashes, ids)
        later = ids > least[place]
        cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
        return pa.table({
            "grp": table.column("grp"), "bucket": table.column("bucket"),
            "bits": pa.array([np.packbits(x).tobytes() for x in np.split(later, cuts)], pa.binary()),
        })

    def cut(key, texts, bits):
        hashes, rows, firsts = _group_windows(texts, width)
        ids = _ids(texts)
        distinct, least, place = _smallest(hashes, ids[rows])
        elsewhere = np.zeros(len(distinct), dtype=bool)
        edges = _bucket_edges(distinct, n_buckets)
        for bucket, packed in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist(), strict=True):
            lo, hi = edges[bucket], edges[bucket + 1]
            elsewhere[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo).astype(bool)
        gone = elsewhere[place] | (ids[rows] > least[place])
        rows, firsts = rows[gone], firsts[gone]  # in row order, then in word order
        first_of = np.searchsorted(rows, np.arange(texts.num_rows + 1))
        n_words, n_removed, kept, removed = [], [], [], []
        for i, text in enumerate(texts.column("text").to_pylist()):
            words = (text or "").encode().split()
            spans = _merge(firsts[first_of[i]:first_of[i + 1]], width)
            stay, at = [], 0
            for a, b in spans:
                stay += words[at:a]
                at = b
            stay += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay).decode())
            removed.append([{"start": a, "end": b} for a, b in spans])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(kept, pa.string()), "removed": pa.array(removed, span),
        })

    answered = (
        grouped.groupBy("grp").applyInArrow(blocks, "grp int, bucket int, block binary")
        .groupBy("bucket").applyInArrow(verdicts, "grp int, bucket int, bits binary")
    )
    return grouped.groupBy("grp").cogroup(answered.groupBy("grp")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>")


def _merge(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals covered by windows that begin at the sorted starts."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > width)
    first = np.concatenate([[0], gap + 1])
    last = np.concatenate([gap, [len(starts) - 1]])
    return [(int(starts[a]), int(starts[b]) + width) for a, b in zip(first, last, strict=True)]


def digest(removed: DataFrame) -> DataFrame:
    """The contract's columns of :func:`dedup_passages`."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], width: int = WIDTH) -> list[tuple]:
    """Plain version for tests: ``(doc_id, n_words, n_removed, kept_sha256)``."""
    least: dict[tuple, int] = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i:i + width])
                least[k] = min(d, least.get(k, d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and least[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
