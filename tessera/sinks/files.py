"""Dataset writes and info documents (K3, K4, K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_pairs(df: DataFrame, out: str, mode: str = "overwrite") -> None:
    """K3: plain parquet write, no index."""
    df.write.mode(mode).parquet(out)


def dataset_info(df: DataFrame, file_path: str) -> DataFrame:
    """K4: one row ``num_samples, file_path, columns``."""
    return df.agg(F.count(F.lit(1)).alias("num_samples")).select(
        "num_samples", F.lit(file_path).alias("file_path"), F.array(*[F.lit(c) for c in df.columns]).alias("columns")
    )


def row_group_info(footers: DataFrame) -> DataFrame:
    """K5: ``path, num_row_groups, num_rows``, one row for each file."""
    return footers.select("path", "num_row_groups", "num_rows")


def write_json_doc(doc: DataFrame, out: str) -> None:
    """Write an info document as JSON.  The rows are brought together after they
    are computed, so what computes them keeps its own tasks."""
    doc.repartition(1).write.mode("overwrite").json(out)


def row_counts(df: DataFrame, by: str = "file") -> DataFrame:
    """A4: rows per input file (``by='file'``, from the scan's hidden
    ``_metadata.file_path``) or per value of a column (e.g. ``split``)."""
    if by == "file":
        return df.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(
            F.count(F.lit(1)).alias("num_samples"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("num_samples"))


def _lengths(df: DataFrame, cols: list[str], *by: str) -> DataFrame:
    """``column, value`` of each column's numbers, all from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("value")) for c in cols])
    return df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.column", "p.value").filter("value IS NOT NULL")


PROFILE = ["column", "rows", "min", "avg", "max", "p25", "p50", "p75"]


def length_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """A6 for a whole dataset: rows, min / avg / max and approximate quartiles of
    each list-length column (one scan and one aggregation; percentiles are
    approximate by design; nulls play no part)."""
    quartiles = F.percentile_approx("value", [0.25, 0.5, 0.75])
    out = _lengths(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("min"), F.avg("value").alias("avg"),
                                                   F.max("value").alias("max"), quartiles.alias("_q"))
    return out.select("column", "rows", "min", "avg", "max", *[F.col("_q")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))])


#: Size of a sketch: ranks are off by at most about 0.65 % of the rows (99 times in 100).
SKETCH_K = 400


def length_sketches(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """A6 by parts: one row for each value of ``by`` (a shard, a file, a day) and
    column, with ``rows, min, max, total`` and a KLL ``sketch`` of a few kilobytes.
    Store them with the parts: :func:`merged_profile` needs nothing else."""
    return _lengths(df, cols, by).groupBy(by, "column").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("total"),
        F.kll_sketch_agg_bigint("value", F.lit(SKETCH_K)).alias("sketch"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The :func:`length_profile` of all parts whose sketches are given; no row of
    the parts is read again."""
    out = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.min("min").alias("min"), (F.sum("total") / F.sum("rows")).alias("avg"), F.max("max").alias("max"),
        F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("_s"))
    return out.select("column", "rows", "min", "avg", "max", *[F.kll_sketch_get_quantile_bigint("_s", F.lit(q)).alias(p) for q, p in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
