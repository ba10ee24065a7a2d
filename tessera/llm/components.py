"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import sizing


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free hash of a set of edges."""
    r = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``a, b`` edges; a component is
    named by its smallest node.

    Each round hangs larger neighbours on the smallest known one; the number of
    rounds grows with the logarithm of the longest chain.  Rounds meet in
    group-bys with map-side combine and equi-joins, so a node with very many
    neighbours is aggregated before the shuffle, and its rows stream through the
    join.  Each round is checkpointed; only a count and a hash reach the driver.
    The tasks of a round follow its edges, which never grow in number.
    """
    spark = edges.sparkSession
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct().checkpoint()
    mark = _mark(current)
    while mark[0]:
        n = sizing.parts(spark, mark[0])
        current = current.coalesce(n)
        both = current.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = current.select(F.col("b").alias("a"), F.col("a").alias("b"))
        # merge: a small side would be gathered for a broadcast by a task for each partition
        large = larger.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(n).distinct()
        large = large.coalesce(n).checkpoint()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        # the row of the least neighbour tells it to the node itself, the others to what they name
        told = large.join(below.hint("merge"), "a").select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
        current = told.coalesce(n).distinct().coalesce(n).checkpoint()
        new = _mark(current)
        if new == mark:
            break
        mark = new
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
