"""Incremental ingest with Structured Streaming.

New record files (JSON Lines) arriving in a folder are converted as they come:
``readStream`` → stateless text transforms → ``foreachBatch`` running the
same batch operators (image lookups are stream-static joins against the image
index) → one output folder per micro-batch.  Each batch overwrites its own
``batch_id=<n>`` folder, so a batch replayed after a failure rewrites the
same rows instead of appending duplicates.  The checkpoint folder must be on
shared storage; by default it goes under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import text as T
from ..operators import ingest as I
from ..operators.images import image_index
from ..schemas import SOURCE
from ..session import ensure_checkpoint_dir, folder_exists, remove_folder
from ..sources.images import ImageFiles, read_images


def read_record_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Source records as a stream (JSON Lines files in ``folder``)."""
    reader = spark.readStream.schema(SOURCE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(folder)


WAITING = "waiting"


def start_layout_a_ingest(
    spark: SparkSession,
    source_folder: str,
    images: DataFrame | str,
    out: str,
    checkpoint: str | None = None,
    on_missing: str = "skip",
    trigger_once: bool = False,
    wait_batches: int = 0,
) -> StreamingQuery:
    """Convert arriving records to layout-A rows, one folder per micro-batch,
    and keep per-batch status counts next to them (``out/_status``).

    ``images`` is a folder, whose referenced files are looked up anew for each
    batch (images may arrive with their records, or after them), or a fixed
    DataFrame.  The default checkpoint is one folder for each ``out``.

    A record none of whose images is there is ``other`` at once, or, with
    ``wait_batches``, ``waiting``: it is kept in ``out/_waiting`` and tried again
    with each following batch, up to so many, before it is ``other``.
    :func:`finish_waiting` settles those that are left when no more batches come.
    Every record ends in one status that is not ``waiting``."""
    if checkpoint is None:
        name = hashlib.md5(out.encode()).hexdigest()
        checkpoint = ensure_checkpoint_dir(spark).rstrip("/") + f"/tessera-ingest-a-{name}"

    def convert(batch: DataFrame, batch_id: int) -> None:
        _convert(batch.sparkSession, batch, batch_id, images, out, on_missing, wait_batches)

    writer = (
        read_record_stream(spark, source_folder)
        .writeStream.foreachBatch(convert)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()


def _waiting_folder(out: str, batch_id: int) -> str:
    return f"{out}/_waiting/batch_id={batch_id}"


def _held(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    """Records that wait since the batch before; each batch reads one folder and
    writes another, so a batch that is run again finds the same ones."""
    folder = _waiting_folder(out, batch_id - 1)
    if not folder_exists(spark, folder):
        return None
    return spark.read.schema(StructType([*SOURCE.fields, StructField("_age", IntegerType())])).parquet(folder)


def _convert(spark: SparkSession, batch: DataFrame, batch_id: int, images: DataFrame | str, out: str, on_missing: str, wait_batches: int) -> None:
    records = batch.withColumn("_age", F.lit(0))
    held = _held(spark, out, batch_id)
    if held is not None:
        records = records.unionByName(held.withColumn("_age", F.col("_age") + 1))
    records = records.persist()
    try:
        if isinstance(images, str) and ImageFiles.reaches(spark, images):
            statuses = I.with_files_a(records, ImageFiles(spark, images)).persist()
            rows = I.ok_layout_a(statuses, on_missing)
        else:
            files = read_images(spark, images) if isinstance(images, str) else images
            hot = I.hot_image_paths(records)
            statuses = I.status_a(records, image_index(files), hot).persist()
            rows = I.to_layout_a(records, files, on_missing, hot)
        missing = (F.col("status") == I.STATUS_OTHER) & I.text_status_a().isNull() & (F.size(T.image_paths(I.TEXT, dotall=False)) > 0)
        if wait_batches:
            statuses = statuses.withColumn("status", F.when(missing & (F.col("_age") < wait_batches), F.lit(WAITING)).otherwise(F.col("status")))
            late = statuses.filter(F.col("status") == WAITING).select(*SOURCE.names, "_age")
            late.write.mode("overwrite").parquet(_waiting_folder(out, batch_id))
        I.ingest_report(statuses).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/_status/batch_id={batch_id}")
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        statuses.unpersist()
    finally:
        records.unpersist()
    if batch_id >= 2:
        remove_folder(spark, _waiting_folder(out, batch_id - 2))


def finish_waiting(spark: SparkSession, images: DataFrame | str, out: str, last_batch: int, on_missing: str = "skip") -> None:
    """Tries the records that still wait after batch ``last_batch`` a last time, as
    batch ``last_batch + 1``; what has no image then is ``other``."""
    none = spark.createDataFrame([], SOURCE)
    _convert(spark, none, last_batch + 1, images, out, on_missing, 0)
    remove_folder(spark, _waiting_folder(out, last_batch))
