"""Parquet footers as a DataFrame.

Footers are read by the executors (``mapInArrow`` over a DataFrame of file
paths), never by the driver, so the work spreads with the number of files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FOOTER
from .filesystems import opened, qualified, reaches


def _facts(paths: list[str], metas: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array([m.num_row_groups for m in metas], pa.int32()), pa.array([m.num_rows for m in metas], pa.int64())],
        names=["path", "num_row_groups", "num_rows"],
    )


def _footer_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        paths, metas = batch.column("path").to_pylist(), []
        for uri in paths:
            fs, p = opened(uri)
            with fs.open_input_file(p) as f:
                metas.append(pq.ParquetFile(f).metadata)
        yield _facts(paths, metas)


def _tail_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        tails = batch.column("tail").to_pylist()
        yield _facts(batch.column("path").to_pylist(), [pq.read_metadata(pa.BufferReader(b"PAR1" + t)) for t in tails])


def _tails(files: DataFrame) -> DataFrame:
    """``path, tail``: a file's bytes from its footer on (the last eight are the
    footer's length, the lowest byte first, and the format's mark)."""
    length = F.conv(F.hex(F.concat(*[F.substring("content", -k, 1) for k in (5, 6, 7, 8)])), 16, 10).cast("int")
    return files.select("path", "content", length.alias("_n")).select("path", F.expr("substring(content, -(_n + 8), _n + 8)").alias("tail"))


def _footers(spark: SparkSession, paths: list[str], glob: str = "*") -> DataFrame:
    """Spark lists the files (the ``binaryFile`` source with only ``path``
    selected, so no file is read by the listing) and executors read the footers —
    the file list never passes through Python on the driver.

    In stores that only Spark's readers reach, ``binaryFile`` reads the files
    (each below its 2 GB) and their footers alone go on to Python."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(paths)
    if not all(reaches(qualified(spark, p)) for p in paths):
        return _tails(files).mapInArrow(_tail_batches, FOOTER)
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return files.select("path").repartition(n).mapInArrow(_footer_batches, FOOTER)


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a parquet dataset (Spark's own file listing)."""
    return sorted(spark.read.parquet(path).inputFiles())


def parquet_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, num_row_groups, num_rows`` for each parquet file; a path may be
    a file or a folder of them."""
    return _footers(spark, paths)


def dataset_footers(spark: SparkSession, path: str) -> DataFrame:
    """S5 for the ``*.parquet`` files of a whole dataset folder."""
    return _footers(spark, [path], "*.parquet")
