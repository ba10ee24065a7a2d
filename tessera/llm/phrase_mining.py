"""Phrase collocations by dynamic itemset counting.

The texts are dealt into ``shards`` shards of equal chance, which are scanned in
turn, over and over.  One scan counts phrases of several lengths together:

* words are counted from the first scan on;
* a longer phrase is counted from the scan after both its parts (it without its
  last word, and without its first) have been seen ``min_count`` times so far;
* each phrase is counted until it has been through every shard once, one full
  cycle from wherever it began; then its count is whole.

A part's running count never exceeds its whole count, and no phrase is more
frequent than its parts, so every phrase of ``min_count`` occurrences is begun
at some scan.  Lengths overlap: pairs begin after the first shard instead of
after the first pass.  The scans end when nothing is left to begin or to finish
(at most ``max_words`` passes; most phrases are through after little more than
one).

In a scan, tasks find the words of their texts in numpy, hash every run of up to
``max_words`` words to 64 bits, look the hashes of its two parts up in two
bitmaps (which phrases have reached the count; which of them so lately that
longer ones may be unfinished), and emit sorted blocks of ``(hash, count)`` by
hash bucket, added up in the task.  One task for each bucket adds the blocks to
the bucket's state, written once for each scan.  The bitmaps have a fixed size,
``2**filter_bits`` bits; a bit set for two phrases only makes a phrase counted
that need not be.  A phrase that is met again in a shard it has been through is
not counted twice.

The scans also spell the phrases: a third bitmap marks what has reached the
count and has no text yet, tasks emit the first occurrence they meet of each, and
the bucket keeps one.  Scans go on until every such phrase is spelled (one more,
as a rule).  Scores and the choice of phrases are joins and windows over the
table of spelled phrases.

Phrases are told apart by 64-bit hash: among F frequent of n different runs,
about F * n / 2**64 accidents (3e-6 for half a million among 10**8).

Words are runs without space or tab in the pieces between ``[.,;:!?]`` and line
ends; A-Z are lower-cased.  Everything is by ``lang``.

Long texts are scanned in stretches that overlap by ``max_words - 1`` words, so
a task's memory does not follow the longest text.

Defined cases: null or empty text: no words; null lang: ``und``; repeated rows
count each time; ids play no part; ties are settled by the order given at
:func:`collocations`; an empty table gives no rows.  Other columns are ignored.
The scans run while the DataFrame is made; ``phrases-*`` below the checkpoint
folder holds the table of frequent phrases until the caller removes it.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import blocks, sizing, wordhash
from tessera.session import ensure_checkpoint_dir, remove_folder

MIN_COUNT = 30
MAX_WORDS = 4
SHARDS = 3
TOP = 2000
COVERED_PERCENT = 80
SCALE = 2_000_000
FILTER_BITS = 25
#: Text of one hash bucket, and hashes and spelled phrases a task holds before it emits them.
BUCKET_CHARS = 16 << 20
HELD_HASHES = 3_000_000
HELD_PHRASES = 300_000
STRETCH_BYTES = 1 << 20

_NEVER = np.uint64(255)
_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = _BREAK
_NO_WORD = _KIND != _WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LONGER = np.uint64(0x9FB21C651E98DF25)


def stretches(data: np.ndarray, limit: int, keep: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts that end between words.  Each begins with the last
    ``keep`` words of the one before; the second value says where the new text
    starts."""
    begin = fresh = 0
    while True:
        end = min(fresh + limit, len(data))
        while end < len(data):
            gap = np.flatnonzero(_NO_WORD[data[end:end + limit]])
            if len(gap):
                end += int(gap[0]) + 1
                break
            end = min(end + limit, len(data))
        yield data[begin:end], fresh - begin
        if end >= len(data):
            return
        starts, _, _ = wordhash.word_spans(data[begin:end], np.array([0, end - begin]), _NO_WORD)
        begin, fresh = begin + (int(starts[-keep]) if len(starts) >= keep else 0) if keep else end, end


class Words:
    """The words of some texts: lower-cased bytes, starts, ends, whether each
    begins a piece, its row, its hash by language, and whether it is new (not of
    the stretch before)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, seeds: np.ndarray, fresh: int):
        self.data = _LOWER[data]
        kind = _KIND[data]
        self.starts, self.ends, first = wordhash.word_spans(data, offs, _NO_WORD)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        piece = np.cumsum(kind == _BREAK, dtype=np.int32)[self.starts]
        self.begins = np.ones(len(self.starts), dtype=bool)
        self.begins[1:] = (piece[1:] != piece[:-1]) | (self.row[1:] != self.row[:-1])
        self.hashes = wordhash.mix64(wordhash.word_hashes(self.data, self.starts, self.ends) ^ seeds[self.row])
        self.new = self.starts >= fresh

    def runs(self, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: the hash of the run from each word on, and whether
        the run lies in one piece."""
        hashes, inside = self.hashes, np.ones(len(self.hashes), dtype=bool)
        yield 1, hashes, inside
        for n in range(2, max_words + 1):
            if len(hashes) < 2:
                return
            hashes = wordhash.mix64(hashes[:-1] * _LONGER + self.hashes[n - 1:] + np.uint64(n))
            inside = inside[:-1] & ~self.begins[n - 1:]
            yield n, hashes, inside

    def spelled(self, at: np.ndarray, n: int) -> list[str]:
        """The runs of ``n`` words from the given words on, joined by one space."""
        raw = self.data.tobytes()
        out = []
        for i, start, end in zip(at.tolist(), self.starts[at].tolist(), self.ends[at + n - 1].tolist(), strict=True):
            text = raw[start:end]
            if b"  " in text or b"\t" in text:
                text = b" ".join(raw[a:z] for a, z in zip(self.starts[i:i + n].tolist(), self.ends[i:i + n].tolist(), strict=True))
            out.append(text.decode())
        return out


class Names:
    """Texts of phrases, with their language, by hash."""

    def __init__(self) -> None:
        self.of: dict[int, tuple[str, str]] = {}

    def add(self, hashes: list[int], langs: list[str], texts: list[str]) -> None:
        for h, lang, text in zip(hashes, langs, texts, strict=True):
            self.of.setdefault(h, (lang, text))

    def pack(self) -> bytes:
        """No text holds a line end, so they are one string."""
        hashes = sorted(self.of)
        langs = sorted({self.of[h][0] for h in hashes})
        at = {lang: i for i, lang in enumerate(langs)}
        told = (np.array(hashes, np.uint64).tobytes(), langs, np.array([at[self.of[h][0]] for h in hashes], np.uint32).tobytes(), "\n".join(self.of[h][1] for h in hashes))
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(told))

    def read(self, packed: bytes) -> None:
        hashes, langs, at, texts = pickle.loads(zstandard.ZstdDecompressor().decompress(packed))
        self.add(np.frombuffer(hashes, np.uint64).tolist(), [langs[i] for i in np.frombuffer(at, np.uint32)], texts.split("\n"))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words_of(batch: pa.RecordBatch, keep: int) -> Iterator[tuple[Words, list[str], int]]:
    """Words of the rows from some row on, with the batch's languages."""
    langs = batch.column(0).to_pylist()
    seed_of = {lang: _seed(lang) for lang in set(langs)}
    seeds = np.array([seed_of[lang] for lang in langs], dtype=np.uint64)
    for row, data, offs in wordhash.text_chunks(batch.column(1), STRETCH_BYTES):
        if len(offs) == 2 and len(data) > STRETCH_BYTES:
            for part, fresh in stretches(data, STRETCH_BYTES, keep):
                yield Words(part, np.array([0, len(part)]), seeds[row:row + 1], fresh), langs, row
        else:
            yield Words(data, offs, seeds[row:], 0), langs, row


#: A task's or a bucket's counts (for ``words`` 0: all words of languages, as JSON), and texts.
BLOCK = "bucket int, words int, block binary, names binary"
_BLOCK = pa.schema([("bucket", pa.int32()), ("words", pa.int32()), ("block", pa.binary()), ("names", pa.binary())])
NONE = np.zeros(0, np.uint64)


class Marks:
    """Three bitmaps over hashes: phrases that have reached the count, those that
    did so lately, and those that have no text yet."""

    def __init__(self, filter_bits: int):
        self.reached, self.late, self.unnamed = (np.zeros((1 << filter_bits) // 8, np.uint8) for _ in range(3))

    def packed(self) -> list[bytes]:
        """As sent to tasks: mostly empty bitmaps take a fraction of their size."""
        return [zstandard.ZstdCompressor(level=3).compress(b.tobytes()) for b in (self.reached, self.late, self.unnamed)]


def _scan(shard: DataFrame, lengths: list[int], marks: Marks, bits: int, max_words: int) -> DataFrame:
    """Counts of a shard: all words if 1 is among ``lengths``, and runs of the
    other lengths whose parts have reached the count, one of them lately; and the
    texts of runs that lack one."""
    top = max_words if marks.unnamed.any() else max(lengths)
    sent = marks.packed()

    def emit(held: dict[int, list[np.ndarray]], named: dict[int, Names], total: dict[str, int]) -> pa.RecordBatch:
        out: list[tuple] = []
        for n in held.keys() | named.keys():
            parts = held.get(n)
            distinct, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (NONE, NONE)
            at = blocks.edges(distinct, bits)
            texts: dict[int, Names] = {}
            for h, name in (named[n].of if n in named else {}).items():
                texts.setdefault(h >> (64 - bits), Names()).of[h] = name
            for b in set(np.flatnonzero(np.diff(at)).tolist()) | texts.keys():
                here = slice(at[b], at[b + 1])
                out.append((b, n, blocks.pack(distinct[here], count[here].astype(np.uint64)), texts[b].pack() if b in texts else None))
        by_bucket: dict[int, dict[str, int]] = {}
        for lang, n in total.items():
            by_bucket.setdefault(_seed(lang) >> (64 - bits), {})[lang] = n
        out += [(b, 0, json.dumps(n).encode(), None) for b, n in by_bucket.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _BLOCK, strict=True)], schema=_BLOCK)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = blocks.interleaved(*map(blocks.bits_of, sent))
        held: dict[int, list[np.ndarray]] = {}
        named: dict[int, Names] = {}
        total: dict[str, int] = {}
        size = texts = 0
        for batch in batches:
            for words, langs, first in _words_of(batch, max_words - 1):
                if 1 in lengths:
                    of_row = np.bincount(words.row[words.new])
                    for row in np.flatnonzero(of_row).tolist():
                        total[langs[first + row]] = total.get(langs[first + row], 0) + int(of_row[row])
                ready = recent = None
                for n, hashes, inside in words.runs(top):
                    here = inside & words.new[n - 1:]
                    if n in lengths:
                        take = here if n == 1 else here & ready[:-1] & ready[1:] & (recent[:-1] | recent[1:])
                        if take.any():
                            held.setdefault(n, []).append(hashes[take])
                            size += int(take.sum())
                    told = blocks.look_up(marks, hashes)
                    at = np.flatnonzero(here & (told >> np.uint32(16) & np.uint32(1) == 1))
                    if len(at):
                        distinct, where = np.unique(hashes[at], return_index=True)
                        names = named.setdefault(n, Names())
                        fresh = np.array([h not in names.of for h in distinct.tolist()])
                        at = at[where[fresh]]
                        names.add(distinct[fresh].tolist(), [langs[first + r] for r in words.row[at].tolist()], words.spelled(at, n))
                        texts += len(at)
                    if n < max(lengths, default=0):
                        ready, recent = told & np.uint32(1) == 1, told >> np.uint32(8) & np.uint32(1) == 1
                if size >= HELD_HASHES or texts >= HELD_PHRASES:
                    yield emit(held, named, total)
                    held, named, total, size, texts = {}, {}, {}, 0, 0
        if held or named or total:
            yield emit(held, named, total)

    return shard.select("lang", "text").mapInArrow(scan, BLOCK)


STATE = f"{BLOCK}, reached binary, late binary, unnamed binary"


def _add(step: int, shards: int, min_count: int, bits: int, filter_bits: int):
    """Adds a scan's blocks to the state of a bucket and a length: hash, count,
    shards it has been through (one bit each), and the scan at which the count
    reached ``min_count``; and the texts of those that did."""
    per_bucket = 1 << (filter_bits - bits)
    seen = np.uint64(1 << (step % shards))

    def row(bucket: int, n: int, block: bytes, names: bytes | None, *marked: np.ndarray):
        bitmaps = [blocks.bits_at((h >> np.uint64(64 - filter_bits)).astype(np.int64) - bucket * per_bucket, per_bucket) for h in marked]
        told = [bucket, n, block, names, *bitmaps]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table([pa.array([x], t) for x, t in zip(told, types, strict=True)], ["bucket", "words", "block", "names", "reached", "late", "unnamed"])

    def add(key, table):
        bucket, n = key[0].as_py(), key[1].as_py()
        given = list(zip(table.column("block").to_pylist(), table.column("names").to_pylist(), table.column("is_state").to_pylist(), strict=True))
        if n == 0:
            total: dict[str, int] = {}
            for block, _, _ in given:
                for lang, k in json.loads(block).items():
                    total[lang] = total.get(lang, 0) + k
            return row(bucket, 0, json.dumps(total).encode(), None, NONE, NONE, NONE)
        old = [NONE] * 4
        parts, names = [], Names()
        for block, texts, is_state in given:
            if texts is not None:
                names.read(texts)
            if is_state:
                old = blocks.unpack(block, 4)
            else:
                parts.append(blocks.unpack(block, 2))
        # the state's own hashes are a run that adds nothing; the rest is this scan's count
        hashes, scanned = blocks.merged([old[0], *(p[0] for p in parts)], [np.zeros(len(old[0]), np.uint64), *(p[1] for p in parts)])
        count, through, reach = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.uint64), np.full(len(hashes), _NEVER)
        at = np.searchsorted(hashes, old[0])
        count[at], through[at], reach[at] = old[1:]
        count += np.where(through & seen == 0, scanned, np.uint64(0))
        through[scanned > 0] |= seen
        reach[(reach == _NEVER) & (count >= min_count)] = step
        if step >= n * shards - 1:  # all cycles of this length are over
            kept = count >= min_count
            hashes, count, through, reach = hashes[kept], count[kept], through[kept], reach[kept]
        there = reach != _NEVER
        lately = there & (reach.astype(np.int64) >= step + 1 - shards)
        known = set(hashes[there].tolist())
        names.of = {h: name for h, name in names.of.items() if h in known}  # others only share a bit
        lacking = np.array([h for h in known if h not in names.of], np.uint64)
        return row(bucket, n, blocks.pack(hashes, count, through, reach), names.pack() if names.of else None, hashes[there], hashes[lately], lacking)

    return add


def _marks(state: DataFrame, bits: int, filter_bits: int, max_words: int) -> Marks:
    """The bitmaps, put together on the driver from each bucket's part."""
    out = Marks(filter_bits)
    size = (1 << (filter_bits - bits)) // 8
    for r in state.filter("words > 0").select("bucket", "words", "reached", "late", "unnamed").toLocalIterator():
        here = slice(r["bucket"] * size, (r["bucket"] + 1) * size)
        out.reached[here] |= blocks.bits_of(r["reached"])
        out.unnamed[here] |= blocks.bits_of(r["unnamed"])
        if r["words"] < max_words:
            out.late[here] |= blocks.bits_of(r["late"])
    return out


FOUND = "lang string, words int, phrase string, n long"


def _told(state: DataFrame, min_count: int) -> DataFrame:
    """The state as rows: texts and counts of the phrases that reached the count."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, block, texts in zip(*(batch.column(c).to_pylist() for c in ("words", "block", "names")), strict=True):
                if n == 0:
                    rows = [(lang, 0, "", k) for lang, k in json.loads(block).items()]
                else:
                    names = Names()
                    if texts is not None:
                        names.read(texts)
                    hashes, count, _, _ = blocks.unpack(block, 4)
                    kept = count >= min_count
                    rows = [(names.of[h][0], n, names.of[h][1], k) for h, k in zip(hashes[kept].tolist(), count[kept].tolist(), strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return state.select("words", "block", "names").mapInArrow(tell, FOUND)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, words, phrase, n``: every phrase of 1 to ``max_words`` words that
    occurs ``min_count`` times, and with ``words`` 0 and an empty phrase the
    number of all words of each language."""
    spark = docs.sparkSession
    sizing.bound_arrow(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/phrases-{uuid.uuid4().hex}"
    dealt = docs.filter("text <> ''").select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text",
        sizing.bucket_of(shards, F.monotonically_increasing_id()).alias("shard"))
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(f"{folder}/texts")
    texts = spark.read.schema("lang string, text string, shard int").parquet(f"{folder}/texts")
    n_buckets = max(sizing.shuffle_partitions(spark), -(-sizing.total_chars(texts) // BUCKET_CHARS))
    bits = min(blocks.bucket_bits(n_buckets), filter_bits - 3)

    marks, step, state = Marks(filter_bits), 0, None
    while step < shards or marks.late.any() or marks.unnamed.any():
        counting = step < shards or marks.late.any()
        lengths = [n for n in range(1, max_words + 1) if counting and n - 1 <= step < n * shards]
        found = _scan(texts.filter(F.col("shard") == step % shards), lengths, marks, bits, max_words).withColumn("is_state", F.lit(False))
        if state is not None:
            found = found.unionByName(state.select("bucket", "words", "block", "names", F.lit(True).alias("is_state")))
        found.groupBy("bucket", "words").applyInArrow(_add(step, shards, min_count, bits, filter_bits), STATE).write.parquet(f"{folder}/state-{step}")
        state = spark.read.schema(STATE).parquet(f"{folder}/state-{step}")
        if step:
            remove_folder(spark, f"{folder}/state-{step - 1}")
        marks = _marks(state, bits, filter_bits, max_words)
        step += 1
    _told(state, min_count).write.parquet(f"{folder}/found")
    for part in ("texts", f"state-{step - 1}"):
        remove_folder(spark, f"{folder}/{part}")
    return spark.read.schema(FOUND).parquet(f"{folder}/found")


def _exact(column: str) -> str:
    return f"cast({column} as decimal(20, 0))"


def scored(found: DataFrame, scale: int = SCALE) -> DataFrame:
    """``lang, words, phrase, a, l, r, score`` of the phrases of two words or
    more: the lowest-scoring cut, the earliest of equal ones."""
    phrases = found.filter("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    phrases = phrases.withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    parts = found.filter("words >= 1")
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # whole numbers of up to 38 digits; no score passes scale / 2, as no part is rarer than its phrase
    score = F.expr(f"{_exact('a')} * {scale} div ({_exact('l')} + {_exact('r')})")
    cut = phrases.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", score)
    least = cut.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return least.select("lang", "words", "phrase", "a", "c.l", "c.r", "c.score")


def _covered(found: DataFrame) -> DataFrame:
    """``lang, phrase, most``: the highest count of a longer phrase around each."""
    inner = "flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m), i -> array_join(slice(w, i + 1, m), ' '))))"
    longer = found.filter("words >= 3").withColumn("w", F.split("phrase", " "))
    return longer.select("lang", F.explode(F.expr(inner)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, covered_percent: int = COVERED_PERCENT,
                 scale: int = SCALE, shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases by score, then ``a`` (both falling), then phrase.  A phrase inside a
    longer one of at least ``covered_percent`` of its count is left out."""
    found = frequent_phrases(docs, min_count, max_words, shards, filter_bits)
    covered = (F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * covered_percent)
    alone = scored(found, scale).join(_covered(found), ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("most")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that no task sorts all of its phrases
    part = sizing.bucket_of(sizing.shuffle_partitions(docs.sparkSession), "phrase")
    firsts = alone.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("at") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = found.filter("words = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
