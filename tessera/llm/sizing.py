"""Sizes that follow the input, and Arrow batches of bounded bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 512
ARROW_BYTES = 2 << 20
PART_ROWS = 10_000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_arrow(spark: SparkSession) -> None:
    """Rows and bytes of text handed to Python at once (one longer text comes
    alone).  These are settings of the session, as Spark reads them when a job
    starts: they stay, unless the session has smaller ones of its own."""
    for name, most in zip(_ARROW, (ARROW_ROWS, ARROW_BYTES), strict=True):
        own = spark.conf.get(name, None)
        if own is None or not own.isdigit() or not 0 < int(own) <= most:
            spark.conf.set(name, str(most))


def total_chars(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.length(column).cast("long"))).first()[0] or 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_per_part(spark: SparkSession, rows: int, most: int, least: int = 1000) -> int:
    """Rows of one part of a group that is cut up: an even share of all rows,
    between ``least`` and ``most``."""
    return max(least, min(most, rows // shuffle_partitions(spark)))


def parts(spark: SparkSession, rows: int) -> int:
    """Tasks for so many short rows: as many as run at once, more from
    ``PART_ROWS`` rows a task on.  A step over few rows then costs no task for
    each shuffle partition."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def bucket_of(n: int, *columns: Column | str) -> Column:
    """A number below ``n`` from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(n).cast("long")).cast("int")
