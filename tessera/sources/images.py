"""Image files as a DataFrame (S2), and read by path where they are needed."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from ..functions.paths import canonical_path, canonical_sql
from .filesystems import opened, parts, qualified, reaches


def read_images(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file below ``root`` → ``path`` (relative to root), ``length``, ``content``.

    Selecting only ``path`` / ``length`` prunes ``content`` from the scan, so
    existence checks never read the bytes.  This lists the whole folder; see
    :class:`ImageFiles` for files that are known by path.
    """
    base = qualified(spark, root)
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(base)
    )
    # binaryFile paths are URIs (file:/…, hdfs://host/…): drop the scheme and
    # authority part in front of the root, then the root itself.
    rel = F.regexp_replace(F.col("path"), r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?" + re.escape(parts(base)[2]) + "/", "")
    return df.select(rel.alias("path"), F.col("length"), F.col("content"))


class _Reader:
    """Files below a root, opened by a task; the ones read last stay at hand up to
    ``CACHE_BYTES``, so an image that many records share is read once in a while
    instead of once a record."""

    THREADS = 8
    CACHE_BYTES = 64 << 20

    def __init__(self, root: str):
        import pyarrow.fs as pafs

        self.fs, self.base = opened(root)
        self.file_type = pafs.FileType.File
        self.held: OrderedDict[str, bytes | None] = OrderedDict()
        self.size = 0
        self.pool = ThreadPoolExecutor(self.THREADS)

    def _place(self, path: str) -> str:
        return path if path.startswith("/") else f"{self.base}/{path}"

    def infos(self, paths: list[str]) -> list:
        """``FileInfo`` of each path; null for what is no file."""
        asked = [p for p in paths if p and not p.endswith("/")]
        found = dict(zip(asked, self.fs.get_file_info([self._place(p) for p in asked]), strict=True)) if asked else {}
        return [i if (i := found.get(p)) is not None and i.type == self.file_type else None for p in paths]

    def _read(self, path: str) -> bytes:
        with self.fs.open_input_stream(self._place(path)) as f:
            return f.read()

    def read(self, paths: list[str]) -> dict[str, bytes | None]:
        """The bytes of each path; null where there is no file.  What is there
        but can't be read raises: a lost connection is no missing image."""
        out = {}
        for p in dict.fromkeys(paths):
            if p in self.held:
                self.held.move_to_end(p)
                out[p] = self.held[p]
        wanted = [p for p in dict.fromkeys(paths) if p not in out]
        there = [p for p, i in zip(wanted, self.infos(wanted), strict=True) if i is not None]
        out |= dict.fromkeys(wanted) | dict(zip(there, self.pool.map(self._read, there), strict=True))
        for p in wanted:
            self.held[p] = out[p]
            self.size += len(out[p] or b"") + 100
        while self.size > self.CACHE_BYTES:
            _, old = self.held.popitem(last=False)
            self.size -= len(old or b"") + 100
        return out


class ImageFiles:
    """Image files below ``root`` that tasks open by path.

    Only files that are asked for are touched, the folder is never listed, and
    bytes are read where the asking row is, so none are shuffled.  Tasks open
    files through Arrow's file systems (local, HDFS, S3, GCS, Azure); for other
    stores use :func:`read_images` (:meth:`reaches` tells).  Paths are
    ``canonical_path`` ones, relative to the root or absolute on its file system.
    """

    #: Bytes of images a task hands back together (one larger row comes alone), and paths asked for together.
    BATCH_BYTES = 8 << 20
    BATCH_PATHS = 64

    def __init__(self, spark: SparkSession, root: str):
        self.root = qualified(spark, root)

    @staticmethod
    def reaches(spark: SparkSession, root: str) -> bool:
        return reaches(qualified(spark, root))

    def facts(self, paths: DataFrame) -> DataFrame:
        """``path, found, length`` of the distinct ``path`` values; no file is opened."""
        root = self.root

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = _Reader(root)
            for batch in batches:
                infos = reader.infos(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i is not None for i in infos]),
                                                  pa.array([i and i.size for i in infos], pa.int64())], ["path", "found", "length"])

        return self._distinct(paths).mapInArrow(look, "path string, found boolean, length long")

    def read(self, paths: DataFrame) -> DataFrame:
        """``path, content`` of the distinct ``path`` values that are files."""
        rows = self.attach(self._distinct(paths).select("path", F.array("path").alias("_p")), "_p", "_c")
        return rows.select("path", F.col("_c")[0].alias("content")).filter("content IS NOT NULL")

    @staticmethod
    def _distinct(paths: DataFrame) -> DataFrame:
        return paths.select(canonical_path("path").alias("path")).filter("path IS NOT NULL").distinct()

    def attach(self, df: DataFrame, paths: str, out: str) -> DataFrame:
        """``df`` with ``out``, an array of the bytes of the files named in the
        array column ``paths`` (null for what is no file; a null array gives
        null).  Rows stay where they are."""
        root, batch_bytes, batch_paths = self.root, self.BATCH_BYTES, self.BATCH_PATHS
        spelled = df.withColumn("_spelled", F.expr(f"transform({paths}, _p -> {canonical_sql('_p')})"))
        schema = StructType([*df.schema.fields, StructField(out, ArrayType(BinaryType()))])
        names = [*df.columns, out]
        kind = pa.list_(pa.binary())

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = _Reader(root)
            for batch in batches:
                asked = batch.column(batch.num_columns - 1).to_pylist()
                columns = batch.columns[:-1]
                begin, images, size = 0, [], 0
                for i, row in enumerate(asked):
                    if row is None:
                        images.append(None)
                    else:
                        images.append([])
                        for k in range(0, len(row), batch_paths):
                            known = reader.read([p for p in row[k:k + batch_paths] if p is not None])
                            images[-1] += [known.get(p) for p in row[k:k + batch_paths]]
                        size += sum(len(b or b"") for b in images[-1])
                    if size >= batch_bytes or i + 1 == len(asked):
                        yield pa.RecordBatch.from_arrays([*(c.slice(begin, len(images)) for c in columns), pa.array(images, kind)], names)
                        begin, images, size = i + 1, [], 0

        return spelled.mapInArrow(load, schema)
