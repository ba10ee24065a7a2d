from collections import Counter

from conftest import SF_SMALL
from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import queries, substring_dedup


def _rows(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def test_query_matches_brute_force(spark):
    docs = [(r[0], r[1]) for r in queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = _rows(queries.op10_substring_dedup(spark, SF_SMALL))
    assert got == Counter(substring_dedup.brute_force(docs))
    assert sum(r[2] for r in got) > 0


def test_odd_cases_small_groups(read_docs):
    docs = [(r["doc_id"], r["text"]) for r in read_docs.collect()]
    found = substring_dedup.dedup_passages(read_docs, group_chars=2000, bucket_chars=500)
    assert _rows(substring_dedup.digest(found)) == Counter(substring_dedup.brute_force(docs))


def test_narrow_windows_and_intervals(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "x a b c y b c d z")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in substring_dedup.dedup_passages(df, width=2).collect()}
    assert rows[1]["n_removed"] == 0
    assert [tuple(s) for s in rows[2]["removed"]] == [(1, 4), (5, 8)]
    assert rows[2]["kept_text"] == "x y z"


def test_touching_windows_merge():
    import numpy as np

    assert substring_dedup._merge(np.array([0, 3, 7]), 3) == [(0, 6), (7, 10)]


def test_empty_table(no_docs):
    assert substring_dedup.digest(substring_dedup.dedup_passages(no_docs)).count() == 0


def test_repeated_rows_are_spread_over_groups(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text)] * 150 + [(None, text)] * 150 + [(i, f"{text} {i}") for i in range(5, 10)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    sizes = [r["count"] for r in substring_dedup._in_groups(df, 10).groupBy("grp").count().collect()]
    assert max(sizes) < 100
    found = substring_dedup.dedup_passages(df, group_chars=1000, bucket_chars=500)
    assert _rows(substring_dedup.digest(found)) == Counter(substring_dedup.brute_force(rows))
