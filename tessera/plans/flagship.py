"""The flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as I
from ..sources import fixtures as X
from .catalog import hot_paths, index_of, query


@query("flagship")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout-B ingest of the record fixture: status with the image check
    (F5, F6, J1), then the solution entries of accepted records (T1, T4, T5)
    with each image's byte length.

    Plan: tag payloads join the narrow image index once (``path, length,
    valid``; no bytes, salted on ``path``); one group by record gives the
    failure count and the lengths by image ordinal; one join brings them back
    to the parsed records.
    """
    records = I.with_record_key(X.cot_source(spark, sf_dir))
    facts = index_of(spark, sf_dir).select("path", "length", "valid")
    refs = I.join_files(I.kept_image_refs(records, dotall=True, key=I.RECORD), facts, "left", hot_paths(spark, sf_dir))
    per_task = refs.groupBy(I.RECORD).agg(
        F.sum(F.when(F.coalesce(F.col("valid"), F.lit(False)), 0).otherwise(1)).alias("_n_bad"),
        F.array_sort(F.collect_set(F.struct("ord", "length"))).alias("_lens"),
    ).filter(F.col("_n_bad") == 0)
    ok = I.parse_layout_b(records).join(per_task, I.RECORD)
    ents = ok.select("task_id", "_lens", F.posexplode("solution_entries").alias("pos", "e"))
    return ents.select(
        "task_id",
        F.col("pos").cast("long").alias("pos"),
        F.col("e.type").alias("type"),
        F.col("e.content").alias("content"),
        F.col("e.index").alias("image_index"),
        F.when(F.col("e.type") == "image", F.get(F.col("_lens"), (F.col("e.index") + 1).cast("int"))["length"]).alias(
            "image_length"),
    )
