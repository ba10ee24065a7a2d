"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own,
``(offset + i * skip) mod size``, from two hashes of its name; as the size is
prime, every such order is a permutation.  Shards take turns, each claiming its
next free slot, until the table is full: every shard owns the same number of
slots, give or take one, and taking a shard away or adding one leaves most other
slots where they were.

A document's slot is a hash of its id; its shard is that slot's owner.  The
table has ``size`` rows whatever the data (a parameter, at least 100 times the
shards), so it is broadcast, and placing a row is one probe: no shuffle, and no
task depends on how many rows a shard gets.

Defined cases: rows without an id are placed by the hash of their text (also if
that is null), so many of them do not meet in one shard; rows with equal ids, and
repeated rows, share a shard; an empty table gives none; no shards, or repeated
names, are an error.  Other columns are ignored by :func:`place` and kept by
:func:`write`.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
#: A prime; about a thousand slots for each of 64 shards.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, math.isqrt(n) + 1))


def _hash(name: str, what: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{what}:{name}".encode(), digest_size=8).digest(), "little")


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Owner (index into ``shards``) of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need at least one name, and no name twice")
    if not _is_prime(size) or size < len(shards):
        raise ValueError(f"the table needs a prime size of at least {len(shards)}, not {size}")
    order = sorted(range(len(shards)), key=lambda s: shards[s])  # the order of the list does not matter
    offset = [_hash(shards[s], "offset") % size for s in order]
    skip = [_hash(shards[s], "skip") % (size - 1) + 1 if size > 1 else 1 for s in order]
    owner = np.full(size, -1, dtype=np.int32)
    left = size
    while left:
        for turn, shard in enumerate(order):
            while owner[offset[turn]] >= 0:
                offset[turn] = (offset[turn] + skip[turn]) % size
            owner[offset[turn]] = shard
            left -= 1
            if not left:
                break
    return owner


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size).cast("long"))


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(slot, shards[s]) for slot, s in enumerate(owner.tolist())], "slot long, shard string")


def place(docs: DataFrame, shards: list[str] | None = None, size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, slot, shard`` for each row of ``docs``."""
    table = table_frame(docs.sparkSession, shards or names(), size)
    slot = F.when(F.col("doc_id").isNotNull(), slot_of(F.col("doc_id").cast("long"), size)).otherwise(slot_of(F.col("text"), size))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), slot.alias("slot")).join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")


def write(docs: DataFrame, path: str, shards: list[str] | None = None, size: int = TABLE_SIZE, files: int = 1) -> None:
    """``docs`` as Parquet below ``path``, one folder ``shard=<name>`` for each
    shard with rows, of about ``files`` files.  Where ``docs`` has a column
    ``shard`` of its own, the folders are named ``shard_=<name>`` (and so on)."""
    name, taken = "shard", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    table = table_frame(docs.sparkSession, shards or names(), size)
    slot = F.when(F.col("doc_id").isNotNull(), slot_of(F.col("doc_id").cast("long"), size)).otherwise(slot_of(F.col("text"), size))
    whole = docs.select(F.struct("*").alias("_doc"), slot.alias("slot"), F.pmod(F.xxhash64(F.lit("file"), "doc_id", "text"), F.lit(files)).alias("_file"))
    placed = whole.join(F.broadcast(table), "slot").repartition("shard", "_file").select("_doc.*", F.col("shard").alias(name))
    placed.write.partitionBy(name).parquet(path)
