"""Image lookups: the joins the reference does with file reads.

``image_index`` scans the image bytes once and keeps ``(path, length, format,
problem, md5)``; every status decision joins that narrow table, so bytes move
only in the final assembly.  Paths meet in one spelling (``functions.paths``),
whatever the records wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.images import format_sql, image_signature, problem_sql
from ..functions.paths import canonical_path
from .skew import HotKeys, salted_join

FILE = "_file"


def with_file(df: DataFrame) -> DataFrame:
    """Adds ``FILE``, the one spelling of ``path``."""
    return df.withColumn(FILE, canonical_path("path"))


def join_files(refs: DataFrame, images: DataFrame, how: str, hot: HotKeys | None = None) -> DataFrame:
    """``refs`` joined to ``images`` by what file their paths name."""
    return salted_join(with_file(refs), with_file(images).drop("path"), FILE, how, hot=hot).drop(FILE)


def image_index(images: DataFrame) -> DataFrame:
    """``path, length, format, problem, valid, md5`` — one row per image file.
    Each file's walk is done once, for its problem; the format is in its head."""
    c = F.col("content")
    # a row number (never negative) in the verdict keeps the optimizer from moving a
    # filter on it below the walk, which would repeat what the content is made of
    there = F.monotonically_increasing_id() >= 0
    signed = images.select("path", F.length(c).cast("long").alias("length"), image_signature("content").alias("_sig"), F.md5(c).alias("md5"))
    return signed.select("path", "length", F.expr(format_sql("_sig")).alias("format"), F.expr(problem_sql("_sig")).alias("problem"), "md5").withColumn(
        "valid", there & F.col("problem").isNull())


def image_lookup(refs: DataFrame, index: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Each reference ``(…, path)`` with its file's facts; repeats stay repeats.

    ``found`` is false for a path with no file (J3's rows).
    """
    facts = index.select("path", "length", "valid", "md5", F.lit(True).alias("_hit"))
    return join_files(refs, facts, "left", hot).withColumn("found", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def missing_images(refs: DataFrame, images: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """References whose file does not exist (the reference's warnings)."""
    return join_files(refs, images.select("path"), "left_anti", hot)


def attach_bytes(refs: DataFrame, images: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """J1 with bytes: ``refs`` plus ``content`` (null when the file is missing)."""
    return join_files(refs, images.select("path", "content"), "left", hot)


def collect_images(refs_with_bytes: DataFrame, key: str = "task_id") -> DataFrame:
    """A3: per record, image bytes of each section in ``pos`` order.

    ``refs_with_bytes`` has ``key, section, pos, content``.  A null ``content``
    (missing file) is dropped from the list but its entry keeps its index —
    the reference's ``skip`` behaviour; see ``apply_missing_policy``.
    Ordering is by the explicit ``pos``, never by ``collect_list`` order.
    """
    def section(name: str) -> F.Column:
        return F.expr(
            f"transform(array_sort(collect_list(IF(section = '{name}' AND content IS NOT NULL, "
            f"named_struct('p', pos, 'b', content), NULL))), _x -> _x.b)"
        )

    return refs_with_bytes.groupBy(key).agg(
        section("question").alias("question_images"),
        section("solution").alias("solution_images"),
    )
