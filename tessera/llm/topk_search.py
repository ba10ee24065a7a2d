"""Exact top-k search by a Voronoi kNN join.

Vectors become integers, ``floor(scale * x)``; the score is the integer inner
product.  One added coordinate ``sqrt(M**2 - |x|**2)`` (0 for queries; M is the
largest norm) turns the largest inner products into the smallest distances:
``d(q, x)**2 = |q|**2 + M**2 - 2 * q.x``.

1. Pivots: a hash sample of at most ``MAX_PIVOTS`` rows; it decides speed only.
   Rows and queries belong to the cell of their nearest pivot.
2. Summaries: of a cell its size, its least and largest distance to the pivot
   and its ``k + 1`` least distances; of a query group its size and radius.
   There are as many as pivots, and they go to the driver.
3. Bounds: a group's queries find ``k`` other rows within ``theta`` =
   the (k+1)-th least of ``radius + d(pivots) + distance in the cell``, so only
   cells with a point that can lie within ``theta`` are visited.
4. A group's queries are replicated to the cells they need (they are the
   smaller side); large cells are cut into blocks of ``BLOCK`` rows and many
   queries into chunks of ``CHUNK``, so a cell with a third of all rows is many
   tasks.  A task solves its block exactly and returns at most ``k`` rows a
   query, none below the query's own bound.
5. The best ``k`` of the blocks' answers, by score, then smaller id.

Bounds are compared with a margin above their rounding errors, and scores are
exact integers (floating-point products only where they are exact).

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part, as queries or as candidates; shorter vectors are filled with
zeros; a query's own row is no candidate, another row with the same id is; rows
with a null id take no part; repeated query rows each have their answers;
fewer than ``k`` candidates: all; scores beyond 64 bits are the largest (or
least) 64-bit number, and tie.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

SCALE, K = 1024, 10
MAX_PIVOTS, BLOCK, CHUNK = 1024, 4096, 512
#: Of the largest norm; far above what rounding does to distances and squares.
MARGIN, SQUARE_MARGIN = 1e-6, 1e-12


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, width)


def _lifted(x: np.ndarray, m2: float, query: bool) -> np.ndarray:
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(m2 - (x * x).sum(axis=1), 0.0))
    return np.hstack([x, last[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q @ x.T).astype(np.int64)
    if most < 2.0**63 and max(np.abs(q).max(), np.abs(x).max()) < 2.0**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = np.array([[int(v) for v in r] for r in q], dtype=object) @ np.array([[int(v) for v in r] for r in x], dtype=object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``node, vec_id, v`` (array of whole doubles) of the rows that take part."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    told = vectors.select(F.monotonically_increasing_id().alias("node"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return told.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("node", "vec_id", x.alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows for which ``is_query``."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    rows = integer_vectors(vectors, scale).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    n, m2, width = rows.agg(F.count("*"), F.max(norm2), F.max(F.size("v"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    n_pivots = max(1, min(MAX_PIVOTS, math.isqrt(n) // 4))
    drawn = rows.orderBy(F.xxhash64("vec_id", "node"), "node").limit(n_pivots).select("v").collect()
    pivots = _lifted(np.array([list(r["v"]) + [0.0] * (width - len(r["v"])) for r in drawn]), m2, False)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell and distance of each row, as a candidate and as a query."""
        for batch in batches:
            x = np.zeros((batch.num_rows, width))
            for i, v in enumerate(batch.column("v").to_pylist()):
                x[i, :len(v)] = v
            asked = batch.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
            near = _distances(_lifted(x, m2, False), pivots)
            near_q = _distances(_lifted(x, m2, True), pivots)
            cell, group = near.argmin(axis=1), near_q.argmin(axis=1)
            at = np.arange(len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), batch.column("vec_id"), batch.column("is_query"),
                pa.array([r.tobytes() for r in x], pa.binary()),
                pa.array(cell, pa.int32()), pa.array(near[at, cell]), pa.array(group, pa.int32()),
                pa.array(np.where(asked, near_q[at, group], 0.0)),
            ], ["node", "vec_id", "is_query", "v", "cell", "far", "grp", "grp_far"])

    placed = rows.mapInArrow(
        place, "node long, vec_id long, is_query boolean, v binary, cell int, far double, grp int, grp_far double").checkpoint()
    ranked = placed.select("cell", "far", F.row_number().over(Window.partitionBy("cell").orderBy("far")).alias("r")).filter(F.col("r") <= k + 1)
    nearest = {r["cell"]: sorted(r["d"]) for r in ranked.groupBy("cell").agg(F.collect_list("far").alias("d")).collect()}
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")).collect()}
    groups = {r["grp"]: r for r in placed.filter("is_query").groupBy("grp").agg(F.count("*").alias("n"), F.max("grp_far").alias("radius")).collect()}
    if not groups:
        return spark.createDataFrame([], schema)

    between = _distances(pivots, pivots)
    slack = MARGIN * (1.0 + math.sqrt(m2))
    visits, asked_of = [], dict.fromkeys(cells, 0)
    for i, group in groups.items():
        reach = sorted(group["radius"] + between[i, j] + d for j, ds in nearest.items() for d in ds)
        theta = reach[k] if len(reach) > k else math.inf
        for j, cell in cells.items():
            least = max(between[i, j] - group["radius"] - cell["hi"], cell["lo"] - between[i, j] - group["radius"])
            if least <= theta + slack:
                visits.append((i, j))
                asked_of[j] += group["n"]
    blocks = {j: max(1, -(-c["n"] // BLOCK)) for j, c in cells.items()}
    chunks = {j: max(1, -(-a // CHUNK)) for j, a in asked_of.items()}
    size = spark.createDataFrame([(j, blocks[j], chunks[j]) for j in cells], "cell int, blocks int, chunks int")  # at most MAX_PIVOTS rows
    visit = spark.createDataFrame(visits, "grp int, to_cell int")  # at most MAX_PIVOTS ** 2 rows

    dealt = placed.select("node", "vec_id", "v", "cell").join(size, "cell").select(
        "cell", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"),
        "node", "vec_id", "v")
    asked = placed.filter("is_query").select(F.col("node").alias("q_node"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "grp").join(visit, "grp").withColumnRenamed("to_cell", "cell").join(size, "cell").select(
        "cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.pmod(F.xxhash64(F.lit("chunk"), "q_node"), F.col("chunks")).cast("int").alias("chunk"),
        "q_node", "query_id", "q")
    known = [(j, nearest[j]) for j in sorted(nearest)]

    def solve(key, data, queries):
        out: tuple[list, ...] = ([], [], [], [], [])
        if data.num_rows and queries.num_rows:
            x, q = _matrix(data.column("v"), width), _matrix(queries.column("q"), width)
            x_node, x_id = data.column("node").to_numpy(), data.column("vec_id").to_numpy()
            score = _scores(q, x)
            q_lift = _lifted(q, m2, True)
            to_pivot = _distances(q_lift, pivots)
            reach = np.concatenate([to_pivot[:, [j]] + np.array(d)[None, :] for j, d in known], axis=1)
            theta = np.partition(reach, k, axis=1)[:, k] + slack if reach.shape[1] > k else np.full(len(q), np.inf)
            q2 = (q * q).sum(axis=1)
            floor = (q2 + m2 - theta**2) / 2 - slack * (1.0 + theta) - SQUARE_MARGIN * (q2 + m2) - 1.0
            floor = np.minimum(floor, 2.0**62)  # scores end at 64 bits
            for i, (node, vec_id) in enumerate(zip(queries.column("q_node").to_pylist(), queries.column("query_id").to_pylist(), strict=True)):
                able = np.flatnonzero((x_node != node) & (score[i] >= floor[i]))
                if len(able) > k:
                    s = score[i][able]
                    able = able[s >= np.partition(s, len(s) - k)[len(s) - k]]
                best = able[np.lexsort((x_node[able], x_id[able], -score[i][able]))][:k]
                for column, values in zip(out, ([node] * len(best), [vec_id] * len(best), x_node[best], x_id[best], score[i][best]), strict=True):
                    column.extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("q_node", "query_id", "node", "vec_id", "score"), out, strict=True)})

    keys = ["cell", "block", "chunk"]
    answers = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(solve, "q_node long, query_id long, node long, vec_id long, score long")
    best = Window.partitionBy("q_node").orderBy(F.col("score").desc(), "vec_id", "node")
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
