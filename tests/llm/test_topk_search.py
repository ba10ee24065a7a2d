import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import queries, topk_search


def _brute(rows, is_query, k):
    fine = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in fine), default=0)
    whole = [(i, [math.floor(1024 * x) for x in v] + [0] * (width - len(v))) for i, v in fine]
    out = []
    for q, (i, v) in enumerate(whole):
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(whole) if c != q)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def _got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, SF_SMALL, "embeddings").collect()]
    assert _got(queries.op6_topk_search(spark, SF_SMALL)) == _brute(rows, lambda i: i % 100 == 0, 10)


def test_odd_cases_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 40)
    monkeypatch.setattr(topk_search, "CHUNK", 7)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 4)) * 3
    rows = [(int(i), [float(x) for x in np.float32(centers[i % 6] + rng.normal(size=4) * 0.05)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(150)]  # one very common vector, ties
    rows += [(0, rows[0][1]), (5000, None), (5010, [1.0, None, 2.0, 3.0]), (5020, [float("nan")] * 4), (5030, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (5040, []), (5050, [2.0, 2.0]), (5060, [-0.0, 1e-9, -1e-9, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"node": F.lit(1), "v": F.lit(2), "cell": F.lit(3)})
    got = _got(topk_search.top_k(df, F.col("vec_id") % 10 == 0, k=5))
    assert got == _brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], lambda i: i % 10 == 0, 5)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert [r[:3] for r in _got(topk_search.top_k(df, F.col("vec_id") == 0))] == [(0, 1, 2), (0, 2, 1)]
    assert topk_search.top_k(df, F.col("vec_id") == 9).count() == 0
    assert topk_search.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2.0**29 + i * 2.0**8), float(i)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = _got(topk_search.top_k(df, F.col("vec_id") == 3, k=4, scale=1))
    exact = sorted((-(int(rows[3][1][0]) * int(v[0]) + 3 * int(v[1])), i) for i, v in rows if i != 3)[:4]
    assert [(g[2], g[3]) for g in got] == [(i, -s) for s, i in exact]
    beyond = spark.createDataFrame([(i, [2.0**40 + i]) for i in range(6)], "vec_id long, embedding array<double>")
    assert [g[2:] for g in _got(topk_search.top_k(beyond, F.col("vec_id") == 0, k=3, scale=1))] == [(i, 2**63 - 1) for i in (1, 2, 3)]
