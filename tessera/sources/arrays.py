"""JSON arrays of records, read by many tasks.

An array file has no line ends to split at, and a byte says little without what
stands before it: a bracket inside a string counts for nothing.  So a file is read
in ranges twice:

1. each range is scanned once and tells how it changes the state, whether it
   begins inside a string or outside: the parity of its quotes, and the depth it
   adds in either case.  A sum over a file's ranges then gives the state at the
   start of each (a few numbers a range, by windows);
2. each range is read again with its state known, and hands on the records that
   *begin* in it; the last one may end in the ranges after it.

A record is an element of the outermost array.  Anything else on that level but
objects, commas and white space, text around the array, and an array that does
not close, raise: a file is read whole or not at all.  A task holds one range, and
the rest of the record that ends beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .filesystems import opened

RANGE_BYTES = 8 << 20
_QUOTE, _BACKSLASH = 0x22, 0x5C
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1


def _quotes(data: np.ndarray, before: bytes) -> np.ndarray:
    """Which bytes are quotes that open or close a string: those after an even
    run of backslashes.  ``before`` ends where the data begin."""
    quote = data == _QUOTE
    slash = data == _BACKSLASH
    if not slash.any() and not before.endswith(b"\\"):
        return quote
    at = np.flatnonzero(quote)
    # length of the run of backslashes that ends right before each quote
    other = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
    last = np.where(at > 0, other[at - 1], -1)
    run = at - 1 - last
    run[last == -1] += len(before) - len(before.rstrip(b"\\"))
    quote[at[run % 2 == 1]] = False
    return quote


def _read(f, start: int, n: int) -> bytes:
    f.seek(start)
    return f.read(n)


def _slashes_before(f, start: int) -> bytes:
    """The run of backslashes that ends at ``start``."""
    n = 64
    while True:
        begin = max(0, start - n)
        before = _read(f, begin, start - begin)
        if begin == 0 or len(before.rstrip(b"\\")):
            return before
        n *= 16


def _outside(quote: np.ndarray, in_string: bool) -> np.ndarray:
    """Which bytes lie outside of strings."""
    return (np.cumsum(quote) + int(in_string)) % 2 == 0


def _state_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for file, start, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fs, where = opened(file)
            with fs.open_input_file(where) as f:
                data = np.frombuffer(_read(f, start, n), np.uint8)
                quote = _quotes(data, _slashes_before(f, start))
            step = _STEP[data].astype(np.int64)
            outside = _outside(quote, False)
            out.append((file, start, n, int(quote.sum()) % 2, int(step[outside].sum()), int(step[~outside].sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), *[pa.int64()] * 5), strict=True)],
                                         ["file", "start", "n", "parity", "depth_outside", "depth_inside"])


def _end_of_record(f, at: int, size: int) -> int:
    """The byte after the object that begins at ``at``."""
    depth, in_string, n = 0, False, 1 << 16
    while at < size:
        data = np.frombuffer(_read(f, at, n), np.uint8)
        quote = _quotes(data, _slashes_before(f, at))
        outside = _outside(quote, in_string)
        level = depth + np.cumsum(np.where(outside, _STEP[data], 0).astype(np.int64))
        if len(closed := np.flatnonzero((level == 0) & outside & (_STEP[data] < 0))):
            return at + int(closed[0]) + 1
        depth, in_string, at, n = int(level[-1]), bool((int(quote.sum()) + in_string) % 2), at + len(data), min(n * 4, RANGE_BYTES)
    raise ValueError("a record of a JSON array does not end")


def _check(file: str, data: np.ndarray, outside: np.ndarray, step: np.ndarray, before: np.ndarray, after: np.ndarray, start: int, last: bool) -> None:
    """Raises unless what lies around the records is an array's."""
    shown = ~_SPACE[data]
    if start == 0 and data[:3].tobytes() == b"\xef\xbb\xbf":
        shown[:3] = False
    around = shown & outside & (before <= 0)  # before the array, and its own bracket
    if not np.isin(data[around], [ord("[")]).all() or around.sum() > 1 or (start > 0 and around.any()):
        raise ValueError(f"{file}: text around the array")
    on_level = shown & outside & (before == 1) & (step >= 0)
    if not np.isin(data[on_level], [ord("{"), ord(",")]).all():
        raise ValueError(f"{file}: an array of records holds something that is no object")
    if last and (int(after[-1]) != 0 or not outside[-1]):
        raise ValueError(f"{file}: the array does not close")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, start, n, size, in_string, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fs, where = opened(file)
            with fs.open_input_file(where) as f:
                data = np.frombuffer(_read(f, start, n), np.uint8)
                outside = _outside(_quotes(data, _slashes_before(f, start)), in_string)
                step = np.where(outside, _STEP[data], 0).astype(np.int64)
                after = depth + np.cumsum(step)
                before = after - step
                opens = np.flatnonzero((step == 1) & (before == 1))
                closes = np.flatnonzero((step == -1) & (after == 1)) + 1
                _check(file, data, outside, step, before, after, start, start + n >= size)
                raw = data.tobytes()
                ends = closes[closes > opens[0]] if len(opens) else closes[:0]
                out = [raw[a:z] for a, z in zip(opens.tolist(), ends.tolist())]
                if len(opens) > len(ends):
                    first = start + int(opens[-1])
                    end = _end_of_record(f, first, size)
                    out.append(_read(f, first, end - first))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r.decode() for r in out], pa.string())], ["record"])


def array_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``record``: the JSON text of each element of the arrays in the files of
    ``path`` (in no order)."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size")).filter("size > 0")
    # a range begins at a multiple of range_bytes, and at no byte inside a character that matters: all of JSON's own are ASCII
    ranges = files.select("file", "size", F.explode(F.expr(f"sequence(0L, size - 1, {range_bytes}L)")).alias("start")).withColumn(
        "n", F.least(F.lit(range_bytes).cast("long"), F.col("size") - F.col("start")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = ranges.repartition(tasks, "file", "start")
    changes = spread.select("file", "start", "n").mapInArrow(_state_changes, "file string, start long, n long, parity long, depth_outside long, depth_inside long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    in_string = changes.withColumn("in_string", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
    added = F.when(F.col("in_string"), F.col("depth_inside")).otherwise(F.col("depth_outside"))
    known = in_string.withColumn("depth", F.coalesce(F.sum(added).over(before), F.lit(0)))
    placed = known.join(files, "file").select("file", "start", "n", "size", "in_string", "depth")
    return placed.repartition(tasks, "file", "start").mapInArrow(_records, "record string")
