"""Quality rules: a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words fall into ``BUCKETS`` hash buckets.  Two
smoothed multinomials over the buckets, one of the trusted target and one of
the raw corpus, give each bucket the weight ``ln(p_target / p_raw)``.  The raw
one adds one to each count; the target one adds ``PRIOR`` times the raw share of
the bucket to each, so what a small target has not seen counts little against a
document, and the less the smaller the target is.  A document's score is the
mean weight of its n-grams (so length does not count), and every document whose
score reaches ``threshold`` is kept: no random draw.

The raw multinomial counts all documents.  The target is the documents with
``quality = 1`` and no ``toxic = 1`` among at most ``max_target`` labelled rows,
those with the least id hash; this is the one bounded sample (it fits the
target model, and its ids are the only rows that are broadcast).  The weights
are ``BUCKETS`` numbers, a size that does not depend on the data.

The base rules come first: fewer than 20 words, or over 30% of the words in
8-word windows that occur twice or more in the text, fail.

Everything is built-in functions on the row itself: no text is shuffled.

Defined cases: null text has no words; a text without words scores 0; labels
with null id or quality are ignored, null toxic counts as 0; without target or
corpus every weight is 0, so only the base rules reject; repeated rows count
and are judged one by one.  Other columns are ignored.  A text is worked on as
one row's arrays of words and hashes, some 30 bytes a word.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
MAX_TARGET = 50_000
#: Pseudo-counts of the target for each bucket, dealt out by the raw shares.
PRIOR_PER_BUCKET = 4
#: Mean weight below which a document is rejected; see the README.
THRESHOLD = -0.1
MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 20, 8, 30
_SPACES = "\\t\\n\\u000B\\u000C\\r"


def words_of(text: str) -> str:
    """SQL: the words of a text, as an array."""
    return f"array_remove(split(translate(coalesce({text}, ''), '{_SPACES}', '     '), ' '), '')"


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("_words", F.expr(words_of(text)))


def features(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    and ``base_failed`` to rows with ``text``."""
    out = with_words(docs)
    # windows of 8 words by the hash of their words' hashes
    out = out.withColumn("_hash", F.expr("transform(_words, w -> xxhash64(w))"))
    next_words = ", ".join(f"_hash[i + {k}]" for k in range(WINDOW))
    out = out.withColumn("_windows", F.expr(
        f"if(size(_words) < {WINDOW}, cast(array() as array<bigint>), transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({next_words})))"))
    # only texts with a repeated window need the places of repeats
    out = out.withColumn("_sorted", F.expr(
        "if(size(array_distinct(_windows)) < size(_windows), array_sort(transform(_windows, (h, i) -> struct(h, i))), null)"))
    out = out.withColumn("_places", F.expr(
        "array_sort(transform(filter(_sorted, (x, i) -> (i > 0 and _sorted[i - 1].h = x.h) or (i < size(_sorted) - 1 and _sorted[i + 1].h = x.h)), x -> x.i))"))
    covered = f"aggregate(_places, named_struct('n', 0L, 'end', 0), (s, p) -> named_struct('n', s.n + p + {WINDOW} - greatest(p, s.end), 'end', p + {WINDOW}), s -> s.n)"
    lines = "filter(split(coalesce(text, ''), '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    out = out.withColumn("_lines", F.expr(lines))
    out = out.withColumns({
        "n_words": F.expr("cast(size(_words) as bigint)"),
        "word_chars": F.expr("cast(length(array_join(_words, '')) as bigint)"),
        "n_symbols": F.expr("cast(size(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]', 0)) as bigint)"),
        "n_dup_lines": F.expr("cast(size(_lines) - size(array_distinct(_lines)) as bigint)"),
        "n_repeat_words": F.expr(f"coalesce({covered}, 0L)"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_windows", "_sorted", "_places", "_lines")


def grams(hashes: str, buckets: int = BUCKETS) -> str:
    """SQL: the buckets of all words and all pairs of neighbours."""
    one = f"transform({hashes}, h -> cast(h & {buckets - 1} as int))"
    two = f"if(size({hashes}) < 2, cast(array() as array<int>), transform(sequence(0, size({hashes}) - 2), i -> cast(xxhash64({hashes}[i], {hashes}[i + 1]) & {buckets - 1} as int)))"
    return f"concat({one}, {two})"


def target_ids(labels: DataFrame, max_target: int = MAX_TARGET) -> DataFrame:
    """Ids of the trusted target; at most ``max_target`` rows."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1) & F.col("doc_id").isNotNull())
    ids = good.select(F.col("doc_id").cast("long").alias("_target")).distinct()
    # ids with a small enough hash are candidates, about twice as many as needed,
    # so that no task sorts the labels of the whole corpus
    share = min(1.0, (2 * max_target + 1000) / max(1, ids.count()))
    if share < 1.0:
        ids = ids.filter(F.xxhash64("_target") <= F.lit(int(-(2**63) + share * 2**64)))
    return ids.orderBy(F.xxhash64("_target"), "_target").limit(max_target)


def weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_target: int = MAX_TARGET, prior_per_bucket: float = PRIOR_PER_BUCKET) -> list[float]:
    """``ln(p_target / p_raw)`` of each bucket, smoothed as the module says."""
    hashed = with_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumn("_hash", F.expr("transform(_words, w -> xxhash64(w))"))
    known = hashed.join(F.broadcast(target_ids(labels, max_target)), F.col("doc_id") == F.col("_target"), "left")
    counted = known.select(F.col("_target").isNotNull().cast("int").alias("target"), F.explode(F.expr(grams("_hash", buckets))).alias("bucket"))
    rows = counted.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("target").alias("target")).collect()  # at most `buckets` rows
    raw, target = sum(r["raw"] for r in rows), sum(r["target"] for r in rows)
    if not target:
        return [0.0] * buckets
    prior = prior_per_bucket * buckets
    out = [math.log(prior / (target + prior))] * buckets  # of what the target has not seen, whatever its raw share
    for r in rows:
        share = (r["raw"] + 1) / (raw + buckets)
        out[r["bucket"]] = math.log((r["target"] / share + prior) / (target + prior))
    return out


def score(weight: list[float], hashes: str = "_hash") -> Column:
    """Mean weight of a row's n-grams; 0 without words."""
    table = F.from_json(F.lit(json.dumps(weight)), "array<double>")
    total = F.aggregate(F.expr(grams(hashes, len(weight))), F.lit(0.0), lambda s, b: s + F.element_at(table, b + 1))
    n = F.expr(f"greatest(2 * size({hashes}) - 1, 0)")
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, max_target: int = MAX_TARGET,
          prior_per_bucket: float = PRIOR_PER_BUCKET) -> DataFrame:
    """``docs`` with the features, ``score`` and ``kept``."""
    weight = weights(docs, labels, buckets, max_target, prior_per_bucket)
    out = features(docs).withColumn("score", score(weight))
    # a row number (never negative) in the verdict keeps the optimizer from
    # moving a filter on it down, which would put whole arrays' expressions in
    # place of their names, inside lambdas
    there = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", there & ~F.col("base_failed") & (F.col("score") >= threshold)).drop("_words", "_hash")


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, unchanged."""
    whole = docs.select(F.struct("*").alias("_doc"), "doc_id", "text")
    return judge(whole, labels, **options).filter("kept").select("_doc.*")


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
