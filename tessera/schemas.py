"""Schemas of the data the pipeline reads and writes."""

from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, MapType, StringType, StructField, StructType,
)

# A source record (JSON): {task_id, gt, pred, cot_text}.
SOURCE = StructType([
    StructField("task_id", LongType()),
    StructField("gt", StringType()),
    StructField("pred", StringType()),
    StructField("cot_text", StringType()),
])

# task_<id>/data.json: only ``options`` is read.
TASK_DATA = StructType([StructField("options", MapType(StringType(), StringType()))])

# Layout A interleave entry (stored as a JSON string); for images, content is the path.
ENTRY_A = StructType([
    StructField("type", StringType()),
    StructField("content", StringType()),
    StructField("index", LongType()),
])
ENTRIES_A = ArrayType(ENTRY_A)

# Layout B entry: fields sorted by name, as pandas/Arrow inference writes them.
ENTRY_B = StructType([
    StructField("content", StringType()),
    StructField("index", LongType()),
    StructField("type", StringType()),
])
IMAGE_B = StructType([StructField("bytes", BinaryType())])

FOOTER = StructType([
    StructField("path", StringType()),
    StructField("num_row_groups", IntegerType()),
    StructField("num_rows", LongType()),
])
