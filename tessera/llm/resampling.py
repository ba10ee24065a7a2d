"""Target-distribution importance resampling.

Documents are drawn so that their hashed n-grams resemble those of a target
set.  Every run of 1 to ``max_n`` words is a feature and falls into one of
``buckets`` buckets by crc32.  The raw corpus and the target are counted; each
bucket's gain is the log ratio of the two smoothed shares (times 1000, floored);
a document's weight is the floored mean gain of its features.  Weight plus a
Gumbel noise taken from a hash of the id is its score, and the highest scores
among the documents of at least ``min_words`` words are drawn: a sample without
replacement in proportion to ``exp(weight / 1000)`` that reruns repeat.

Features are found by batch concatenation: the texts of a batch are joined with
a separator that no word holds, one regular expression passes over the whole
string, ``searchsorted`` over the texts' offsets says which text a word is in,
runs whose first and last words lie in different texts are masked out, and the
rest are counted by ``bincount``.  The crc32 of a longer run continues that of
the run without its last word.  A text of more than ``BATCH_BYTES`` comes in
stretches that end between words; the last ``max_n - 1`` words go over to the
next stretch.

Spark's part: two passes over the texts (counts by bucket, summed by Spark; then
one narrow row for each document, written once), a count of the scores, and a
global index over the drawn part.  Driver: ``buckets`` counts and one cut-off.
Scores are whole numbers within about 50,000 of zero, whatever the corpus, so
the count of scores is a table of bounded size.

Defined cases: null or empty text, or text without words: no features, weight
0, never drawn (unless ``min_words`` is 0); a null id takes part with the noise
of an empty id and comes last among ties; repeated rows and rows with one id are
scored and drawn one by one (equal rows in any order); an empty corpus gives no
rows, an empty target draws by the corpus alone.  Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import sizing
from tessera.operators.order import global_index
from tessera.session import ensure_checkpoint_dir

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
SHARE_PERCENT = 10
SEED = 2024
BATCH_BYTES = 1 << 20

#: Word characters of lower-cased UTF-8: digits, letters, and all beyond ASCII.
_WORD = re.compile(rb"([0-9a-z\x80-\xff]+)")
_BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_SENTINEL = b"\x00"


def words_of(joined: bytes) -> tuple[list[bytes], np.ndarray]:
    """All words of a string and their starts, from one pass."""
    parts = _WORD.split(joined)  # between, word, between, ..., word, between
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return parts[1::2], (np.cumsum(lengths) - lengths)[1::2]


def runs(texts: list[bytes], max_n: int, carried: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """``(text, crc32)`` of every run of 1 to ``max_n`` words, the words of each
    text, and the last ``max_n - 1`` words.  ``carried`` words stand before the
    first text; runs of such words alone are not told again."""
    joined = _SENTINEL.join(texts).lower()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(_SENTINEL)
    offsets = np.cumsum(sizes) - sizes
    words, starts = words_of(joined)
    text = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(text, minlength=len(texts))
    old = len(carried or [])
    if old:
        words, text = [*carried, *words], np.concatenate([np.zeros(old, np.int64), text])
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    at, found = [text[old:]], [crc[old:]]
    for n in range(2, max_n + 1):
        crc = np.fromiter(map(zlib.crc32, [b" " + w for w in words[n - 1:]], crc[:len(words) - n + 1].tolist()), np.uint32, max(0, len(words) - n + 1))
        last = np.arange(n - 1, n - 1 + len(crc))
        inside = (text[:len(crc)] == text[n - 1:]) & (last >= old)
        at.append(text[n - 1:][inside])
        found.append(crc[inside])
    return np.concatenate(at), np.concatenate(found), n_words, words[max(0, len(words) - max_n + 1):]


def stretches(text: bytes, limit: int) -> Iterator[bytes]:
    """``text`` in parts of about ``limit`` bytes that end between words."""
    at = 0
    while len(text) - at > limit and (gap := _BETWEEN.search(text, at + limit)):
        yield text[at:gap.end()]
        at = gap.end()
    yield text[at:]


def batches_of(texts: Iterator[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes], bool]]:
    """``(first row, texts, goes on)``: rows joined up to ``limit`` bytes; a
    longer row comes alone, in stretches, all but the first of which go on."""
    held: list[bytes] = []
    size = first = 0
    for row, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held, False
            held, size = [], 0
        if not held:
            first = row
        if len(text) > limit:
            for k, part in enumerate(stretches(text, limit)):
                yield row, [part], k > 0
        else:
            held.append(text)
            size += len(text)
    if held:
        yield first, held, False


def _features(column: pa.Array, max_n: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(row, crc32)`` of runs and the word counts of rows from a first row on."""
    carried: list[bytes] = []
    for first, texts, goes_on in batches_of((t.as_py() or b"" for t in column.cast(pa.binary())), limit):
        text, crc, n_words, last = runs(texts, max_n, carried if goes_on else None)
        carried = last
        yield text + first, crc, n_words, first


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N, limit: int = BATCH_BYTES) -> np.ndarray:
    """Features of all texts by bucket; ``buckets`` numbers reach the driver."""
    sizing.bound_arrow(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _, _ in _features(batch.column(0), max_n, limit):
                total += np.bincount(crc % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(target share / raw share))`` of each bucket, one added to every count."""
    buckets = len(raw)
    ratio = (target + 1).astype(np.float64) * float(raw.sum() + buckets) / ((raw + 1).astype(np.float64) * float(target.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, max_n: int = MAX_N, limit: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: one row for each row of ``docs``."""
    sizing.bound_arrow(docs.sparkSession)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, crc, n_words, first in _features(batch.column(1), max_n, limit):
                words[first:first + len(n_words)] += n_words
                here = row - first
                n = np.bincount(here, minlength=len(n_words))
                features[first:first + len(n)] += n
                # whole numbers far below 2**53, so sums of doubles are exact
                total[first:first + len(n)] += np.bincount(here, weights=gain[crc % len(gain)], minlength=len(n_words)).astype(np.int64)
            mean = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, features, mean))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int = SEED, doc_id: str = "doc_id") -> str:
    """SQL: 1000 times a standard Gumbel variate, floored, from a hash of the id."""
    h = f"cast(conv(substring(sha2(concat('{seed}:', coalesce(cast({doc_id} as string), '')), 256), 1, 8), 16, 10) as bigint)"
    return f"floor(-1000 * ln(-ln(({h} + 0.5D) / 4294967296D)))"


def resample(docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: one row for each
    row of ``docs``; ``rank`` (from 1, by score) is null for what is not drawn.
    ``target`` has ``text``."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets, max_n), bucket_counts(target, buckets, max_n))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/resampled-{uuid.uuid4().hex}"
    scored = weighed(docs, gain, max_n).withColumn("score", F.expr(f"weight + {noise(seed)}"))
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    scored = spark.read.schema("doc_id long, n_words long, n_features long, weight long, score long, row long").parquet(folder)

    fit = F.col("n_words") >= min_words
    by_score = scored.filter(fit).groupBy("score").agg(F.count("*").alias("n"))
    n = by_score.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    drawn = share_percent * n // 100
    above = by_score.withColumn("above", F.sum("n").over(Window.orderBy(F.desc("score"))))
    cut = above.filter(F.col("above") >= max(drawn, 1)).agg(F.max("score")).first()[0]
    in_reach = fit & (F.col("score") >= F.lit(cut)) if drawn else F.lit(False)
    order = [F.col("score").desc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("row").asc_nulls_last()]
    high = global_index(scored.filter(in_reach), order, "at")
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    return high.select(*out, F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank")).unionByName(
        scored.filter(~in_reach).select(*out, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn."""
    ids = resample(docs, target, **options).filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("_drawn")), "left_semi")


def digest(resampled: DataFrame) -> DataFrame:
    """The contract's columns of :func:`resample`."""
    return resampled.select("doc_id", "n_features", "weight", "score", "rank")
