"""Index-addressable shards and their manifest (K1, K2).

Shard ``s`` holds rows ``[s*N, (s+1)*N)`` of the dataset order.  Rows are
range-partitioned on ``shard_id`` so a shard never straddles two tasks, which
gives one file per shard directory.  ``maxRecordsPerFile`` would only cap file
size; it cannot make shards addressable by row index.

A shard is a small file, so a large table has very many, and what a file costs to
open and commit counts more than its rows.  Plain rows below a store that tasks
reach are written by the tasks through Arrow; other rows, and other stores, by
Spark's writer.  Folders, columns and rows are the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import chunk, global_index
from ..session import ensure_checkpoint_dir, folder_exists, remove_folder
from ..sources.filesystems import opened, qualified, reaches


def shard_path(shard_id: Column) -> Column:
    return F.concat(F.lit("shard_id="), shard_id.cast("string"))


def assign_shards(df: DataFrame, order: list[str | Column], samples_per_file: int = 100,
                  num_ranges: int | None = None) -> DataFrame:
    """Adds ``gi`` (W3) and ``shard_id``."""
    return chunk(global_index(df, order, "gi", num_ranges=num_ranges), samples_per_file)


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """K2: per shard ``path, num_samples, start_idx, end_idx`` (end exclusive)."""
    return sharded.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.min("gi").alias("start_idx"),
        (F.max("gi") + 1).alias("end_idx"),
    ).select("shard_id", shard_path(F.col("shard_id")).alias("path"), "num_samples", "start_idx", "end_idx")


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """K2 totals: ``total_samples, num_files`` (zero for an empty dataset)."""
    return manifest.agg(
        F.coalesce(F.sum("num_samples"), F.lit(0)).cast("long").alias("total_samples"),
        F.count(F.lit(1)).cast("long").alias("num_files"),
    )


#: Types and compressions that Arrow and Spark write alike.
PLAIN = frozenset({"bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "string"})
CODECS = frozenset({"snappy", "gzip", "zstd"})
#: Bytes of one shard a task holds before it closes a row group.
GROUP_BYTES = 64 << 20


def _plain(df: DataFrame, out: str) -> bool:
    alike = all(f.dataType.simpleString() in PLAIN and not f.metadata for f in df.schema.fields)
    return alike and reaches(out) and df.sparkSession.conf.get("spark.sql.parquet.compression.codec") in CODECS


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The stretches of equal ``shard_id`` of each batch, without that column."""
    for batch in batches:
        ids = batch.column("shard_id").to_numpy()
        cuts = [0, *((ids[1:] != ids[:-1]).nonzero()[0] + 1).tolist(), len(ids)]
        rows = batch.drop_columns(["shard_id"])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield int(ids[lo]), rows.slice(lo, hi - lo)


def _write_plain(sharded: DataFrame, out: str) -> None:
    """Each shard's rows, which follow one another in one task, into one file.  It
    gets its name when it is whole, and a task that runs again writes the same."""
    codec = sharded.sparkSession.conf.get("spark.sql.parquet.compression.codec")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        import pyarrow.parquet as pq

        fs, root = opened(out)
        shards = 0
        for shard, runs in itertools.groupby(_runs(batches), key=lambda r: r[0]):
            folder = f"{root}/shard_id={shard}"
            part, held, size = f"{folder}/.part-{uuid.uuid4().hex}", [], 0
            fs.create_dir(folder, recursive=True)
            writer = None
            for _, rows in runs:
                writer = writer or pq.ParquetWriter(part, rows.schema, filesystem=fs, compression=codec)
                held.append(rows)
                size += rows.nbytes
                if size >= GROUP_BYTES:
                    writer.write_table(pa.Table.from_batches(held))
                    held, size = [], 0
            if held:
                writer.write_table(pa.Table.from_batches(held))
            writer.close()
            fs.move(part, f"{folder}/part-00000.{codec}.parquet")
            shards += 1
        yield pa.RecordBatch.from_arrays([pa.array([shards], pa.int64())], names=["n"])

    fs, root = opened(out)
    fs.create_dir(root, recursive=True)
    try:
        sharded.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    except BaseException:
        remove_folder(sharded.sparkSession, out)
        raise
    with fs.open_output_stream(f"{root}/_SUCCESS"):
        pass


def write_shards(df: DataFrame, out: str, order: list[str | Column], samples_per_file: int = 100,
                 num_ranges: int | None = None, mode: str = "overwrite", materialize: bool = True) -> DataFrame:
    """K1: write ``out/shard_id=<s>/part-*.parquet`` and ``out_manifest`` (JSON).

    Indexing reads its input three times (range sampling, per-range counts,
    the write), so unless ``materialize=False`` the input is first written to
    the session's shared checkpoint folder with a reliable ``checkpoint()``
    and read from there.  The manifest follows from the number of rows, so no
    shard is read back or listed; an empty input gives no shards and a zero
    manifest.  Returns the manifest DataFrame read back from disk.
    """
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sharded = assign_shards(df, order, samples_per_file, num_ranges).repartitionByRange(n_parts, "shard_id").sortWithinPartitions("shard_id", "gi")
    base = qualified(spark, out)
    if _plain(sharded, base) and not folder_exists(spark, base):
        _write_plain(sharded, base)
    else:
        sharded.write.mode(mode).partitionBy("shard_id").parquet(out)
    total = df.count()
    begin, n = F.col("shard_id") * samples_per_file, F.lit(samples_per_file).cast("long")
    manifest = df.sparkSession.range(-(-total // samples_per_file)).withColumnRenamed("id", "shard_id").select(
        "shard_id", shard_path(F.col("shard_id")).alias("path"), F.least(n, F.lit(total) - begin).alias("num_samples"),
        begin.alias("start_idx"), F.least(begin + n, F.lit(total).cast("long")).alias("end_idx"))
    manifest.write.mode("overwrite").json(f"{out}_manifest/files")
    manifest_totals(manifest).write.mode("overwrite").json(f"{out}_manifest/totals")
    return df.sparkSession.read.schema(MANIFEST).json(f"{out}_manifest/files")


GROUPS = "shard_id long, path string, row_group int, num_samples long, start_idx long, end_idx long"


def write_shard_groups(df: DataFrame, out: str, order: list[str | Column], samples_per_file: int = 100, num_files: int | None = None,
                       mode: str = "overwrite", materialize: bool = True) -> DataFrame:
    """K1 for many shards: ``out/part-*.parquet`` files of consecutive shards, each
    shard one row group, and ``out_manifest/groups``, an offset table of ``shard_id,
    path, row_group, num_samples, start_idx, end_idx`` (``path`` is the file's name).

    A million shards are as many rows of the table but only ``num_files`` files
    (the session's shuffle partitions, unless given).  The writer closes a row group
    after ``samples_per_file`` rows, and files hold whole shards, so row group ``k``
    of a file is its ``k``-th shard.  :func:`read_shard` reads one of them.  An empty
    input gives an empty table.  Returns the table.
    """
    spark = df.sparkSession
    if materialize:
        ensure_checkpoint_dir(spark)
        df = df.checkpoint()
    sharded = assign_shards(df, order, samples_per_file)
    n_files = num_files or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    (
        sharded.repartitionByRange(n_files, "shard_id")
        .sortWithinPartitions("gi")
        .write.mode(mode)
        .option("parquet.block.row.count.limit", samples_per_file)
        .option("parquet.block.size", (1 << 31) - 1)  # rows alone close a group
        .parquet(out)
    )
    written = spark.read.schema(sharded.schema).parquet(out)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    found = written.select("shard_id", "gi", name.alias("path")).groupBy("path", "shard_id").agg(
        F.count(F.lit(1)).alias("num_samples"), F.min("gi").alias("start_idx"), (F.max("gi") + 1).alias("end_idx"))
    first = found.groupBy("path").agg(F.min("shard_id").alias("_first"))
    table = found.join(first, "path").select("shard_id", "path", (F.col("shard_id") - F.col("_first")).cast("int").alias("row_group"), "num_samples", "start_idx", "end_idx")
    table.write.mode("overwrite").parquet(f"{out}_manifest/groups")
    return spark.read.schema(GROUPS).parquet(f"{out}_manifest/groups")


def read_shard(spark: SparkSession, out: str, shard_id: int) -> DataFrame:
    """The rows of one shard of :func:`write_shard_groups`: one file is opened, and
    of it one row group is read (the others' ranges of ``gi`` exclude them)."""
    place = spark.read.schema(GROUPS).parquet(f"{out}_manifest/groups").filter(F.col("shard_id") == shard_id).first()
    if place is None:
        raise ValueError(f"no shard {shard_id} in {out}")
    rows = spark.read.parquet(f"{out}/{place['path']}")
    return rows.filter((F.col("gi") >= place["start_idx"]) & (F.col("gi") < place["end_idx"])).drop("shard_id")


MANIFEST = "shard_id long, path string, num_samples long, start_idx long, end_idx long"
