"""Run a registered query on Spark and its oracle SQL on DuckDB, and compare
row count, column names and the multiset of rows (order-insensitive)."""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, sf_dir, con=None):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    ok = sc == dc and sr == dr
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"columns spark={sc} duck={dc}"
        else:
            only_s = list((sr - dr).items())[:3]
            only_d = list((dr - sr).items())[:3]
            detail = f"rows spark={len(s_rows)} duck={len(d_rows)} only_spark={only_s} only_duck={only_d}"
    return ok, len(s_rows), len(d_rows), detail


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import time

    from __spark_entry__ import oracle_sql, queries
    from tessera.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    con = duck(sf)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in sqls:
            n = fn(spark, sf).count()
            print(f"{name:24s} rows-only {n} ({time.time()-t0:.1f}s)")
            continue
        try:
            ok, ns, nd, detail = compare(spark, name, fn, sqls[name], sf, con)
        except Exception as e:  # noqa: BLE001
            ok, ns, nd, detail = False, -1, -1, f"{type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} ({time.time()-t0:.1f}s) {detail}")
    print("failures:", bad)
