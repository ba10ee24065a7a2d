"""Record, option and prepared-dataset readers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE, TASK_DATA
from .arrays import array_records
from .filesystems import opened, qualified, reaches


def read_cot(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Source records with a fixed schema.

    JSON Lines are split by Spark's reader, JSON *arrays* by byte ranges
    (``arrays.array_records``), so one large file of either kind is many tasks.
    (On stores that only Spark's readers reach, an array file is one task, read
    with ``multiLine``.)  Unless ``multiline`` says
    which, the head of each file tells its kind (whatever the kind of path: local,
    URI, folder, glob), and files of both kinds raise: with
    ``multiLine``, Spark would keep the first record of JSON Lines and say
    nothing.  Records that do not parse fail the job instead of becoming empty
    records.
    """
    if multiline is None:
        arrays, lines = file_kinds(spark, path)
        if arrays and lines:
            raise ValueError(f"{path} has JSON arrays (such as {arrays}) and JSON Lines (such as {lines}): read them apart")
        multiline = arrays is not None
    if multiline and reaches(qualified(spark, path)):
        parsed = F.from_json("record", SOURCE, {"mode": "FAILFAST"})
        return array_records(spark, path).select(parsed.alias("r")).select("r.*")
    return spark.read.schema(SOURCE).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def file_kinds(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """A file whose first non-blank character opens a JSON array, and one whose
    does not; null where there is none.  Tasks read the head of each file; the
    whole text is read only on stores that nothing but Spark's readers reaches."""
    files = spark.read.format("binaryFile").load(path).select("path")  # lists, and opens nothing
    if reaches(qualified(spark, path)):
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        heads = files.repartition(n).mapInArrow(_heads, "file string, first string")
    else:
        text = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.regexp_extract("value", r"^\uFEFF?\s*(\S)", 1).alias("first"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
        heads = text.filter("first <> ''").groupBy("file").agg(F.min_by("first", "at").alias("first"))
    array = F.col("first") == "["
    return tuple(heads.filter("first <> ''").agg(F.min(F.when(array, F.col("file"))), F.min(F.when(~array, F.col("file")))).first())


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first character of each file that is no white space."""
    for batch in batches:
        firsts = []
        for uri in batch.column(0).to_pylist():
            fs, where = opened(uri)
            with fs.open_input_stream(where, compression="detect") as f:
                head = f.read(HEAD_BYTES).removeprefix(b"\xef\xbb\xbf").lstrip()
                while not head and (more := f.read(HEAD_BYTES)):
                    head = more.lstrip()
            firsts.append(head[:1].decode("ascii", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(firsts, pa.string())], ["file", "first"])


HEAD_BYTES = 1 << 14


def read_task_options(spark: SparkSession, root: str) -> DataFrame:
    """S3: ``root/task_<id>/data.json`` → ``task_id, options``.

    Only the ``options`` key is parsed; a file without it gives an empty map.
    Tasks with no file simply have no row (J2 turns that into ``''``).
    """
    raw = (
        spark.read.schema(TASK_DATA)
        .option("multiLine", True)
        .json(f"{root.rstrip('/')}/task_*/data.json")
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), r"task_(\d+)/data\.json$", 1).cast("long").alias("task_id"),
            F.coalesce(F.col("options"), F.create_map().cast("map<string,string>")).alias("options"),
        )
    )
    return raw


def read_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Prepared parquet (either layout)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)
