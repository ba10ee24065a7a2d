"""Best-fit packing planned over a length histogram.

Texts become token ids (plus an end id); a document longer than ``max_tokens``
is cut into pieces, the first of which takes the remainder.  Pieces are packed
without gaps into sequences of at most ``max_tokens``:

1. tokenise in Arrow batches; write one row for each piece, with its ids, as
   Parquet below the checkpoint folder;
2. count pieces by length: at most ``max_tokens`` rows, the only thing that
   reaches the driver;
3. plan best fit decreasing over the *counts*: a run of equal pieces goes into
   a run of sequences with equal room, so the plan's size depends on
   ``max_tokens`` and not on the number of documents;
4. rank the pieces within their length (numbered in salted parts of a length,
   so a length that a third of all pieces share is no single task) and join
   rank ranges with the plan; only row numbers and lengths move here;
5. join the places to the pieces by row number, so that the ids are shuffled
   once and evenly.

Ids are bytes: unsigned 32 bits each, little-endian (``numpy.frombuffer(ids,
"<u4")``).  :func:`sequences` puts the pieces together.

Equal units of text (white space and the word after it) are tokenised once in
a group, and frequent short ones remembered between groups: byte-level BPE never merges
across the start of white space.  Equal units are found by 64-bit hash.  A long
text is tokenised in stretches; its ids are held whole by one task.

``pack`` writes the pieces and counts them when it is called; ``pieces-*`` below
the checkpoint folder is read by its result, and is the caller's to remove.

Defined cases: a null or empty text is the end id alone, one piece; repeated
rows and equal or null ids are packed one by one; an empty table gives none.
Other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import sizing, wordhash
from tessera.session import ensure_checkpoint_dir

MAX_TOKENS = 1024
END_ID = 2
#: Text that is hashed together, and tokenised together; ids sent back together, and pieces that one task ranks.
CHUNK_BYTES = 1 << 20
GROUP_BYTES = 1 << 20
GATHERED_UNITS = 200_000
IDS_BYTES = 4 << 20
PIECES_PER_TASK = 200_000
#: A plan of more rows than this is not broadcast.
BROADCAST_ROWS = 100_000
#: Units of at most so many bytes whose ids a worker remembers.
CACHED_UNITS = 200_000
CACHED_UNIT_BYTES = 64
SPECIAL = "<|endoftext|>"

PIECE = "doc_id long, piece int, start long, length long, ids binary"
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

#: Characters of three bytes that are white space to the tokenizer, not to the word splitter (fixed values).
_WIDE_SPACES = [b"\xe1\x9a\x80", *(b"\xe2\x80" + bytes([b]) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\xe2\x81\x9f", b"\xe3\x80\x80"]


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str):
    """Encoder of one text: ids as bytes (unsigned 32 bits, little-endian)."""
    import tiktoken
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    from_char = {c: b for b, c in _byte_alphabet().items()}
    special = {t: i for t, i in vocabulary.items() if t == SPECIAL}
    ranks = {bytes(from_char[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encoding = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> bytes:
        ids = encoding.encode(text, allowed_special="all") if SPECIAL in text else encoding.encode_ordinary(text)
        return array.array("I", ids).tobytes()

    return encode


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}}


@functools.lru_cache(maxsize=2)
def _unit_cache(path: str) -> dict[int, bytes]:
    return {}


def _odd_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words whose last character is white space to the tokenizer only."""
    last, second = data[ends - 1], data[np.maximum(ends - 2, 0)]
    odd = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
    wide = np.flatnonzero((last >= 0x80) & ((second == 0x80) | (second == 0x81) | (second == 0x9A)) & (ends >= 3))
    for i in wide:
        odd[i] = data[ends[i] - 3:ends[i]].tobytes() in _WIDE_SPACES
    return odd


def _stretches(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in parts of about ``limit`` bytes, cut between a visible
    ASCII character and the white space after it: no token lies across."""
    begin = 0
    while begin < len(data):
        end = begin + limit
        while end < len(data):
            near = data[end - 1:end + limit]
            cuts = np.flatnonzero((near[:-1] > 0x20) & (near[:-1] < 0x7F) & ((near[1:] == 0x20) | ((near[1:] >= 0x09) & (near[1:] <= 0x0D))))
            if len(cuts):
                end += int(cuts[0])
                break
            end += limit
        yield data[begin:end]
        begin = end


def token_ids(texts: pa.Array | pa.ChunkedArray, path: str) -> Iterator[bytes]:
    """The ids of each text, in order.  Some ``GROUP_BYTES`` of text are worked
    on at a time, in the middle of a long text too."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for _, data, offs in wordhash.text_chunks(texts, CHUNK_BYTES):
        if len(data) <= CHUNK_BYTES:
            held.append((data, offs))
        if held and (len(data) > CHUNK_BYTES or sum(len(d) for d, _ in held) >= GROUP_BYTES):
            yield from _group_ids(held, path)
            held = []
        if len(data) > CHUNK_BYTES:
            parts = [(part, np.array([0, len(part)])) for part in _stretches(data, CHUNK_BYTES)]
            step = max(1, GROUP_BYTES // CHUNK_BYTES)
            yield b"".join(ids for i in range(0, len(parts), step) for ids in _group_ids(parts[i:i + step], path))
    if held:
        yield from _group_ids(held, path)


def _group_ids(chunks: list[tuple[np.ndarray, np.ndarray]], path: str) -> list[bytes]:
    """The ids of each text of some chunks: equal units are looked up once."""
    encode, cache = byte_bpe(path), _unit_cache(path)
    hashes, sizes, counts, odd, texts = [], [], [], [], 0
    for data, offs in chunks:
        starts, ends, first = wordhash.word_spans(data, offs)
        # a unit runs from the end of the word before it; the last of a text is its trailing white space
        n_words = np.diff(first)
        unit_end = np.insert(ends, first[1:], offs[1:])
        unit_start = np.empty_like(unit_end)
        unit_start[1:] = unit_end[:-1]
        unit_start[first[:-1] + np.arange(len(n_words))] = offs[:-1]
        hashes.append(wordhash.word_hashes(data, unit_start, unit_end))
        sizes.append(unit_end - unit_start)
        counts.append(n_words + 1)
        if len(ends):
            for i in np.unique(np.searchsorted(first, np.flatnonzero(_odd_ends(data, ends)), "right") - 1).tolist():
                odd.append((texts + i, data[offs[i]:offs[i + 1]].tobytes()))
        texts += len(n_words)
    keys, at, inverse, seen = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True, return_counts=True)
    size = np.concatenate(sizes)
    raw = b"".join(d.tobytes() for d, _ in chunks)  # units lie one after the other
    begin = np.cumsum(size) - size
    room = CACHED_UNITS - len(cache)
    ids = []
    for key, a, n, often in zip(keys.tolist(), begin[at].tolist(), size[at].tolist(), seen.tolist(), strict=True):
        known = cache.get(key)
        if known is None:
            known = encode(raw[a:a + n].decode())
            if often > 1 and room > 0 and n <= CACHED_UNIT_BYTES:
                cache[key] = known
                room -= 1
        ids.append(known)
    per_unit = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    source = np.cumsum(per_unit) - per_unit
    last = np.cumsum(np.concatenate(counts))
    out, row = [], 0
    while row < texts:  # a few texts at a time keep the gathered places small
        stop = max(row + 1, int(np.searchsorted(last, (last[row - 1] if row else 0) + GATHERED_UNITS, "right")))
        units = inverse[last[row - 1] if row else 0:last[stop - 1]]
        n = per_unit[units]
        total = np.cumsum(n)
        gathered = flat[np.repeat(source[units] - (total - n), n) + np.arange(total[-1])].tobytes()
        borders = 4 * np.concatenate([[0], total])[last[row:stop] - (last[row - 1] if row else 0)]
        out += [gathered[a:z] for a, z in zip([0, *borders[:-1].tolist()], borders.tolist(), strict=True)]
        row = stop
    for i, text in odd:
        out[i] = encode(text.decode())
    return out


def cut_points(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens."""
    first = n - (-(-n // max_tokens) - 1) * max_tokens
    return [(0, first), *((s, max_tokens) for s in range(first, n, max_tokens))]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches of about ``GROUP_BYTES`` of text together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.column(1).nbytes for b in held) >= GROUP_BYTES:
            yield held
            held = []
    if held:
        yield held


def pieces(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row for each piece, with its ids."""
    sizing.bound_arrow(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE, strict=True)], schema=_PIECE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            out: list[tuple] = []
            size = 0
            doc_ids = (i for b in group for i in b.column(0).to_pylist())
            for doc_id, ids in zip(doc_ids, token_ids(pa.chunked_array([b.column(1) for b in group]), path), strict=True):
                ids += end
                for k, (start, length) in enumerate(cut_points(len(ids) // 4, max_tokens)):
                    out.append((doc_id, k, start, length, ids[4 * start:4 * (start + length)]))
                    size += 4 * length
                    if size >= IDS_BYTES:
                        yield rows(out)
                        out, size = [], 0
            if out:
                yield rows(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, PIECE)


def plan(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: ``(length, first_rank, end_rank,
    first_sequence, per_sequence, offset)``.

    Pieces of one length fill the sequences with the least sufficient room
    first, one sequence after the other, then open new ones.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, how many)
    out: list[tuple[int, int, int, int, int, int]] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def place(first: int, n: int, each: int, free: int) -> None:
            nonlocal left, rank
            out.append((length, rank, rank + n * each, first, each, max_tokens - free))
            rank, left = rank + n * each, left - n * each
            if free - each * length:
                room.setdefault(free - each * length, []).append((first, n))

        for free in sorted(r for r in room if r >= length):
            each = free // length
            while left and room[free]:
                first, n = room[free].pop()
                full = min(n, left // each)
                part = int(full < n and left % each > 0)
                if full:
                    place(first, full, each, free)
                if part:
                    place(first + full, 1, left, free)
                if n > full + part:
                    room[free].append((first + full + part, n - full - part))
            if not room[free]:
                del room[free]
        each = max_tokens // length
        if left >= each:
            n = left // each
            first, opened = opened, opened + n
            place(first, n, each, max_tokens)
        if left:
            first, opened = opened, opened + 1
            place(first, 1, left, max_tokens)
    return out


def ranked(rows: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``rank`` (from 0) within ``length``.  A frequent length is numbered
    in parts of an even share of all rows, ``PIECES_PER_TASK`` at most."""
    share = sizing.rows_per_part(rows.sparkSession, sum(histogram.values()), PIECES_PER_TASK)
    parts = max(1, -(-max(histogram.values(), default=0) // share))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts).cast("long")))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("length", "_part").agg(F.count("*").alias("n")).select(
        "length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "_part").orderBy("_row")
    return (numbered.withColumn("_at", F.row_number().over(within) - 1).join(offsets, ["length", "_part"])
            .withColumn("rank", F.col("before") + F.col("_at")).drop("_row", "_part", "_at", "before"))


def pack(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pieces-{uuid.uuid4().hex}"
    numbered = pieces(docs, path, max_tokens, end_id).withColumn("row", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(folder)
    cut = spark.read.schema(f"{PIECE}, row long").parquet(folder)
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(histogram, max_tokens)
    table = spark.createDataFrame(slots, "slot_length long, first_rank long, end_rank long, first_sequence long, per_sequence long, slot_offset long")
    if len(slots) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    taken = ranked(cut.select("row", "length"), histogram).join(
        table, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    at = F.col("rank") - F.col("first_rank")
    places = taken.select(
        "row",
        (F.col("first_sequence") + F.expr("(rank - first_rank) div per_sequence")).alias("sequence_id"),
        (F.col("slot_offset") + (at % F.col("per_sequence")) * F.col("length")).alias("offset"),
    )
    return cut.join(places, "row").select(
        "doc_id", "piece", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids, pieces`` of :func:`pack`'s rows: one row for
    each sequence, its ids whole, its pieces (``offset, length, doc_id, piece,
    start``) by offset.  A sequence has at most ``max_tokens`` of either."""
    by_offset = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "start", "ids"))).alias("_pieces"))
    return by_offset.select(
        "sequence_id",
        F.expr("aggregate(_pieces, 0L, (n, p) -> n + p.length)").alias("length"),
        F.expr("unhex(array_join(transform(_pieces, p -> hex(p.ids)), ''))").alias("ids"),
        F.expr("transform(_pieces, p -> struct(p.offset, p.length, p.doc_id, p.piece, p.start))").alias("pieces"),
    )


def digest(packed: DataFrame) -> DataFrame:
    """The contract's columns of :func:`pack`."""
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def least_sequences(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> int:
    """A lower bound: all tokens, or all pieces longer than half a sequence."""
    return max(-(-sum(k * n for k, n in histogram.items()) // max_tokens), sum(n for k, n in histogram.items() if 2 * k > max_tokens))
