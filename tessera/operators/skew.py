"""Equi-joins that survive keys holding a large share of the rows or bytes.

A shared image (say the same ``composite.png`` referenced by a third of all
records) makes the ``path`` join key hot.  ``hot_keys`` counts rows by key (added
up before the shuffle) and, where the right side's row sizes are given, weighs
each key by the bytes its rows will carry.  What it finds is a table of any
length, ``key, salts``: the shares a key is cut into, so that no share exceeds
the limit.  ``salted_join`` joins that table to both sides: a hot key's left rows
are spread over its shares by a deterministic hash of the row (so a recomputed
task sends every row to the same place), and its right rows are repeated once a
share.  Cold keys keep share 0 and join as usual.  No row is dropped, and no
number of hot keys is left out.

The table is broadcast up to ``BROADCAST_KEYS`` keys (its length is counted
first); beyond that it is joined by a shuffle of the left side's own columns,
which adaptive execution splits by itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SALT = "_salt"

# Rows, and bytes, that one task should see for a single key before it is split.
DEFAULT_HOT_KEY_ROWS = 2_000_000
DEFAULT_HOT_KEY_BYTES = 256 << 20
BROADCAST_KEYS = 50_000


class HotKeys(NamedTuple):
    """``table`` has ``key, salts``; ``n`` is its length."""

    table: DataFrame | None
    n: int

    def __bool__(self) -> bool:
        return self.n > 0

    def salts(self) -> dict:
        """For small tables: shares by key."""
        return {r[0]: r[1] for r in self.table.collect()} if self.n else {}


NONE = HotKeys(None, 0)


def _conf_int(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def hot_key_rows(df: DataFrame) -> int:
    return _conf_int(df, "tessera.skew.hotKeyRows", DEFAULT_HOT_KEY_ROWS)


def hot_key_bytes(df: DataFrame) -> int:
    return _conf_int(df, "tessera.skew.hotKeyBytes", DEFAULT_HOT_KEY_BYTES)


# Counts by rows look at a Bernoulli sample holding about this many rows per
# threshold's worth of data (exact when the threshold is small).
SAMPLE_ROWS_PER_THRESHOLD = 20_000


def sample_share(min_rows: int) -> float:
    return min(1.0, SAMPLE_ROWS_PER_THRESHOLD / max(min_rows, 1))


def hot_keys(df: DataFrame, key: str, min_rows: int, sizes: DataFrame | None = None, min_bytes: int | None = None, sampled: float = 1.0) -> HotKeys:
    """Keys of ``df`` with ``min_rows`` rows or more, or with ``min_bytes`` bytes
    or more on rows of ``sizes`` (``key, bytes``: of one row that a left row
    meets).

    Without ``sizes`` the count is over a row sample with a fixed seed: a key
    holding ``min_rows`` rows shows up about ``SAMPLE_ROWS_PER_THRESHOLD`` times,
    so it cannot be missed, and a false positive only costs a few repeated
    right-side rows.  Few rows of large images make a key hot too, so with
    ``sizes`` every row counts.  ``sampled`` is the share of the rows that ``df``
    already is.
    """
    share = sampled
    if sizes is None and sampled >= 1.0:
        share = sample_share(min_rows)
        df = df if share >= 1.0 else df.sample(fraction=share, seed=17)
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    cut = min_rows if share >= 1.0 else max(1, int(min_rows * share * 0.5))
    rows = (F.col("_n") / F.lit(share * min_rows)) if share < 1.0 else F.col("_n") / F.lit(min_rows)
    load, hot = rows, F.col("_n") >= cut
    if sizes is not None:
        largest = sizes.groupBy(key).agg(F.max("bytes").alias("_bytes"))
        counted = counted.join(largest, key, "left")
        by_bytes = F.coalesce(F.col("_n") * F.col("_bytes"), F.lit(0)) / F.lit(min_bytes or hot_key_bytes(df))
        load, hot = F.greatest(rows, by_bytes), hot | ((by_bytes > 1) & (F.col("_n") > 1))
    # a share takes half the limit at most, as hashes do not deal out evenly
    shares = F.least(F.ceil(2 * load), F.greatest(F.col("_n") / F.lit(share), F.lit(2))) if sizes is not None else F.ceil(load) + 1
    ensure_checkpoint_dir(df.sparkSession)
    table = counted.filter(hot).select(F.col(key), shares.cast("int").alias("salts")).checkpoint()
    n = table.count()
    return HotKeys(table, n) if n else NONE


def _with_salts(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    table = hot.table.select(F.col(hot.table.columns[0]).alias(key), F.col("salts").alias("_salts"))
    return df.join(F.broadcast(table) if hot.n <= BROADCAST_KEYS else table, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    min_rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``left.join(right, key, how)`` with hot left keys split over shares.

    Supported ``how``: inner, left, left_semi, left_anti (the left side is the
    one that may be skewed; every left row still meets each matching right row
    exactly once).  ``hot`` skips the detection pass when the caller already
    knows the hot keys of this input.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "leftsemi", "left_anti", "leftanti"):
        raise ValueError(f"salted_join does not support how={how!r}")
    if hot is None:
        hot = hot_keys(left, key, min_rows if min_rows is not None else hot_key_rows(left))
    if not hot:
        return left.join(right, key, how)

    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    left_s = _with_salts(left, key, hot).withColumn(SALT, F.pmod(row_hash, F.col("_salts")).cast("int")).drop("_salts")
    right_s = _with_salts(right, key, hot).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return left_s.join(right_s, [key, SALT], how).drop(SALT)
