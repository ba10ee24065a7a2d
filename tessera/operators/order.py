"""Global order without a one-partition window.

``global_index`` gives every row its 0-based position in a total order with
one shuffle of the rows:

1. every row gets a *bucket* that is monotone in the order: the leading hex
   digits of an md5 shuffle key, or the quantile interval of a numeric key
   (``approxQuantile`` bounds, binary search by ``Bucketizer``);
2. rows per bucket come from a map-side-combined count — a table of at most
   ``B`` rows, whose running sums (offsets) are the only thing broadcast;
3. rows are hash-partitioned by bucket (which clusters each bucket in one
   task) and numbered with ``row_number`` over a window per bucket.

``B`` is a few times the shuffle partition count, so buckets are small and
balanced: no single task sorts a large share of the data.  Other orders (text
or descending keys, or a first key with few values or many nulls) are range
partitioned on *all* their keys; that frame is written once to the checkpoint
folder, and counts and rows are both read from it, so they always agree.

The order must be unique (add a tiebreak key): then the result is
deterministic, and a task recomputed after an executor loss yields the same
numbers.  A unique key also means no single key value can overload a bucket.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_B, _R, _N, _OFF = "_gi_part", "_gi_row", "_gi_n", "_gi_off"
BUCKETS_PER_PARTITION = 4
# A bucket of more than UNEVEN times its share (and SMALL_BUCKET rows) is split by range.
UNEVEN, SMALL_BUCKET = 8, 10_000


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    if num_ranges:
        return int(num_ranges)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _offsets(counts: DataFrame, total_col: str | None) -> DataFrame:
    """Running row offsets per bucket (a table of at most B rows)."""
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        _B,
        F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("long").alias(_OFF),
        *([F.sum(_N).over(Window.partitionBy()).cast("long").alias(total_col)] if total_col else []),
    )


def hex_bucket(hex_col: Column, digits: int) -> Column:
    """Bucket of an md5 hex key: its first ``digits`` hex digits (monotone in the
    key; an empty one is in the first)."""
    return F.coalesce(F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long"), F.lit(0).cast("long"))


def _quantile_bucket(df: DataFrame, key: str, n_buckets: int):
    """A ``Bucketizer`` over approximate quantiles of a numeric key (at most
    ``n_buckets`` bounds reach the driver) and its output column name."""
    from pyspark.ml.feature import Bucketizer

    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = sorted({b for b in df.approxQuantile(key, probs, 1.0 / (4 * n_buckets)) if math.isfinite(b)})
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    tmp = "_gi_bucket"
    bucketizer = Bucketizer(splits=splits, inputCol=key, outputCol=tmp, handleInvalid="keep")
    return bucketizer, tmp


def global_index(
    df: DataFrame,
    order: list[str | Column],
    col: str = "gi",
    total_col: str | None = None,
    num_ranges: int | None = None,
    materialize: bool = False,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``col`` = 0-based position in ``order`` (and the row count as
    ``total_col`` when given).

    ``bucket`` may give a bucket column monotone in the order (``shuffle``
    passes the md5 prefix); otherwise a numeric first key is bucketed by
    quantiles.  The input is read twice (counts and rows); an expensive input
    should be written once first — ``materialize=True`` does that with a
    reliable ``checkpoint()`` into the shared checkpoint folder.
    """
    if materialize:
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    n = _num_ranges(df, num_ranges)
    first = order[0]
    k0 = "_gi_k0"
    if bucket is not None:
        bucketed = df.withColumn(_B, bucket)
    else:
        if _is_sort_order(first):
            return _global_index_by_range(df, order, col, total_col, n)
        keyed = df.withColumn(k0, F.col(first) if isinstance(first, str) else first)
        if not isinstance(keyed.schema[k0].dataType, NumericType):
            return _global_index_by_range(df, order, col, total_col, n)
        by_keys, order = order, [k0, *order[1:]]
        bucketizer, tmp = _quantile_bucket(keyed, k0, n * BUCKETS_PER_PARTITION)
        keyed = keyed.withColumn("_gi_key", F.col(k0).cast("double"))
        bucketizer.setInputCol("_gi_key")
        bucketed = bucketizer.transform(keyed).withColumn(
            _B, F.when(F.col(k0).isNull(), F.lit(-1)).otherwise(F.col(tmp)).cast("long")
        ).drop(tmp, "_gi_key")
    counts = bucketed.groupBy(_B).agg(F.count(F.lit(1)).alias(_N))
    if bucket is None and len(order) > 1:  # few values of the first key: split them over the later ones
        most, total = counts.agg(F.max(_N), F.sum(_N)).first()
        if (most or 0) > UNEVEN * (total or 0) / (n * BUCKETS_PER_PARTITION) + SMALL_BUCKET:
            return _global_index_by_range(df, by_keys, col, total_col, n)
    rank = F.row_number().over(Window.partitionBy(_B).orderBy(*order)) - 1
    out = (
        bucketed.repartition(n, _B)
        .withColumn(_R, rank.cast("long"))
        .join(F.broadcast(_offsets(counts, total_col)), _B)
        .withColumn(col, (F.col(_OFF) + F.col(_R)).cast("long"))
    )
    return out.drop(_B, _R, _OFF, k0)


def _is_sort_order(key: str | Column) -> bool:
    return isinstance(key, Column) and bool(re.search(r" (ASC|DESC) NULLS (FIRST|LAST)'>$", str(key)))


def _global_index_by_range(df: DataFrame, order: list[str | Column], col: str, total_col: str | None,
                           n: int) -> DataFrame:
    """Range partitions over the whole order (partition id monotone in it), rank
    inside the partition, offsets from per-partition counts.  The partitioned
    rows are checkpointed: a second range exchange would draw other bounds."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(_B, F.spark_partition_id())
        .withColumn(_R, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
        .checkpoint()
    )
    counts = ranged.groupBy(_B).agg(F.count(F.lit(1)).alias(_N))
    out = ranged.join(F.broadcast(_offsets(counts, total_col)), _B).withColumn(col, (F.col(_OFF) + F.col(_R)).cast("long"))
    return out.drop(_B, _R, _OFF)


def shuffle_key(key: Column, seed: int | str, epoch: int | None = None) -> Column:
    """O2: a seeded pseudo-random sort key; the same on every engine (md5)."""
    salt = f"{seed}:" if epoch is None else f"{seed}:{epoch}:"
    return F.md5(F.concat(F.lit(salt), key.cast("string")))


def shuffle(df: DataFrame, key: str, seed: int | str = 42, epoch: int | None = None, col: str = "gi",
            total_col: str | None = None, num_ranges: int | None = None) -> DataFrame:
    """O2: seeded permutation; ``col`` is the row's position in it.  Each epoch
    mixes its number into the seed.  (``rand(seed)`` is not used: it depends on
    the partitioning.)"""
    h = "_shuffle_h"
    n = _num_ranges(df, num_ranges)
    digits = 1
    while 16 ** digits < n * BUCKETS_PER_PARTITION and digits < 8:
        digits += 1
    place = F.coalesce(shuffle_key(F.col(key), seed, epoch), F.lit(""))  # rows without a key come first
    out = global_index(df.withColumn(h, place), [h, key], col, total_col, num_ranges,
                       bucket=hex_bucket(F.col(h), digits))
    return out.drop(h)


def train_test_split(df: DataFrame, key: str, ratio: float = 0.9, seed: int | str = 42,
                     num_ranges: int | None = None) -> DataFrame:
    """O3 + O7: the first ``int(n * ratio)`` shuffled rows are ``train``, the
    rest ``test``; ``split_idx`` restarts at 0 in each split (reset_index).
    The count comes from the bounded offsets table, not a second pass."""
    out = shuffle(df, key, seed, col="_perm", total_col="_total", num_ranges=num_ranges)
    n_train = F.floor(F.col("_total").cast("double") * F.lit(float(ratio))).cast("long")
    is_train = F.col("_perm") < n_train
    return out.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test"))).withColumn(
        "split_idx", F.when(is_train, F.col("_perm")).otherwise(F.col("_perm") - n_train)
    ).withColumnRenamed("_perm", "perm_idx").drop("_total")


#: Rows of the last range of hashes that are put in order to find the cut.
CUT_ROWS = 100_000
_HEX_DIGITS = 4


def split_cut(keys: DataFrame, key: str, ratio: float, seed: int | str) -> tuple[str | None, object, int, int]:
    """Where the first ``int(n * ratio)`` rows of the seeded permutation end:
    ``(hash, key, rows of that key that still are in front, rows of that key)``.

    Selection, not a sort: rows are counted by the leading digits of their hash
    (at most 16**4 counts a round), only the range that holds the cut is looked at
    again, and once it is small its narrow rows are put in order."""
    hashed = keys.select(F.coalesce(shuffle_key(F.col(key), seed), F.lit("")).alias("h"), F.col(key).alias("k"))
    n = hashed.count()
    left = math.floor(n * float(ratio))
    if left <= 0 or n == 0:
        return None, None, 0, 0
    digits = 0
    size = n
    while size > CUT_ROWS and digits + _HEX_DIGITS <= 32:
        digits += _HEX_DIGITS
        counts = sorted((r["p"], r["n"]) for r in hashed.groupBy(F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        for prefix, size in counts:
            if left <= size:
                break
            left -= size
        hashed = hashed.filter(F.substring("h", 1, digits) == prefix)
    # equal keys stand together: the key at which the count is reached
    order = Window.orderBy("h", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_key = hashed.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(order))
    cut = by_key.filter(F.col("upto") >= left).orderBy("upto").first()
    return cut["h"], cut["k"], left - (cut["upto"] - cut["n"]), cut["n"]


def exact_split(df: DataFrame, key: str, ratio: float = 0.9, seed: int | str = 42) -> DataFrame:
    """O3 without moving rows: adds ``split``, the sides of
    :func:`train_test_split`, by comparing each row's hash with the cut.

    Counts are exact.  Rows that share the key at the cut, if it falls among them,
    are told apart by a hash of their content (and only those are shuffled).  Rows
    with a null key stand first in the permutation, as nulls do in an order."""
    h, k, front, same = split_cut(df.select(key), key, ratio, seed)
    place = F.coalesce(shuffle_key(F.col(key), seed), F.lit(""))
    if h is None:
        return df.withColumn("split", F.lit("test"))
    ahead = (place < h) | ((place == h) & (F.col(key) < F.lit(k)))
    at = (place == h) & F.col(key).eqNullSafe(F.lit(k))
    if front in (0, same):
        is_train = F.coalesce(ahead | (at & F.lit(front > 0)), F.lit(False))
        return df.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
    tied = F.coalesce(at, F.lit(False))
    plain = df.filter(~tied).withColumn("split", F.when(F.coalesce(ahead, F.lit(False)), F.lit("train")).otherwise(F.lit("test")))
    rows = df.filter(tied).withColumn("_tie", F.xxhash64(F.to_json(F.struct(*df.columns)))).withColumn("_row", F.monotonically_increasing_id())
    ordered = global_index(rows, [F.col("_tie").asc(), F.col("_row").asc()], "_at")
    return plain.unionByName(ordered.withColumn("split", F.when(F.col("_at") < front, F.lit("train")).otherwise(F.lit("test"))).drop("_tie", "_row", "_at"))


def chunk(df: DataFrame, size: int, index_col: str = "gi", col: str = "shard_id") -> DataFrame:
    """Consecutive slices of ``size`` rows."""
    return df.withColumn(col, F.floor(F.col(index_col) / F.lit(size)).cast("long"))


def split_integrity(split_df: DataFrame, full: DataFrame, key: str) -> DataFrame:
    """Train and test are disjoint and together cover the input.

    Returns ``metric, value`` rows (n_total, n_train, n_test, n_overlap,
    n_missing, n_extra), all from one union of tagged keys, one count per key
    and one total.
    """
    side = F.when(F.col("split") == "train", 1).when(F.col("split") == "test", 2)
    tagged = full.select(F.col(key).alias("k"), F.lit(0).alias("side")).unionByName(
        split_df.select(F.col(key).alias("k"), side.alias("side")).filter("side IS NOT NULL"))
    per_key = tagged.groupBy("k").agg(*[F.count(F.when(F.col("side") == i, 1)).alias(c) for i, c in enumerate(("f", "tr", "te"))])
    zero = F.lit(0).cast("long")
    metrics = {
        "n_total": F.col("f"), "n_train": F.col("tr"), "n_test": F.col("te"), "n_overlap": F.least("tr", "te"),
        "n_missing": F.greatest(F.col("f") - F.col("tr") - F.col("te"), zero), "n_extra": F.greatest(F.col("tr") + F.col("te") - F.col("f"), zero),
    }
    totals = per_key.agg(*[F.coalesce(F.sum(v), zero).alias(m) for m, v in metrics.items()])
    return totals.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])).alias("r")).select("r.*")
