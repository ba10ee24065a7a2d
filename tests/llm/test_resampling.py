import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import queries
from tessera.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def _plain_features(text, max_n):
    w = WORD.findall((text or "").translate(LOW))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def _plain(docs, target, share=10, min_words=20, max_n=1, buckets=10_000, seed=2024):
    """``(doc_id, n_features, weight, score, rank)`` by the definition."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    feats = [(d, *_plain_features(t, max_n)) for d, t in docs]
    s = Counter(bucket(f) for _, _, fs in feats for f in fs)
    t = Counter(bucket(f) for x in target for f in _plain_features(x, max_n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for d, n_words, fs in feats:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words])
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(fit[:share * len(fit) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB1é .\n\x00 Z", max_size=40), max_size=8), st.integers(1, 4), st.integers(1, 12))
def test_runs_of_a_batch_are_those_of_each_text(texts, max_n, limit):
    raw = [t.encode() for t in texts]
    found, counted, carried = [[] for _ in texts], [0] * len(texts), []
    for first, part, goes_on in R.batches_of(iter(raw), limit):  # tiny batches: texts come in stretches
        at, crc, n_words, last = R.runs(part, max_n, carried if goes_on else None)
        carried = last
        for i, c in zip((at + first).tolist(), crc.tolist()):
            found[i].append(c)
        for i, n in enumerate(n_words.tolist()):
            counted[first + i] += n
    for text, got, n in zip(texts, found, counted):
        n_words, want = _plain_features(text, max_n)
        assert n == n_words and sorted(got) == sorted(zlib.crc32(f.encode()) for f in want)


def test_query_equals_the_definition(spark):
    from conftest import SF_MID

    docs = [tuple(r) for r in queries.table(spark, SF_MID, "documents").select("doc_id", "text").collect()]
    target = [r[0] for r in queries.table(spark, SF_MID, "benchmark").select("text").collect()]
    got = [tuple(r) for r in queries.op11_importance_resampling(spark, SF_MID).collect()]
    want = _plain(docs, target)
    assert _sorted(got) == _sorted(want)
    assert sum(r[4] is not None for r in got) > 50


def test_longer_runs_and_shares(spark, read_docs):  # noqa: F811
    target = spark.createDataFrame([("shared1 shared2 shared3",), (None,), ("w1 tail",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in read_docs.collect()]
    got = R.digest(R.resample(read_docs, target, share_percent=60, min_words=1, max_n=3, buckets=97)).collect()
    want = _plain(rows, [r[0] for r in target.collect()], 60, 1, 3, 97)
    drop = lambda rs: _sorted((*r[:4], None if r[0] == 2 else r[4]) for r in rs)  # noqa: E731 - equal ids: any order
    assert drop(map(tuple, got)) == drop(want)
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, sum(r[4] is not None for r in want) + 1))
    assert R.drawn_documents(read_docs, target, share_percent=60, min_words=1).columns == read_docs.columns


def test_many_rows_with_one_id(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(30_000).selectExpr("if(id < 10000, 7, id) as doc_id", "repeat(concat('a b c ', cast(id % 9 as string), ' '), 6) as text", "id as score").write.parquet(path)
    out = R.resample(spark.read.parquet(path), spark.createDataFrame([("a 1",)], "text string"), share_percent=50).cache()
    ranked = out.filter("rank is not null")
    assert out.count() == 30_000 and ranked.count() == 15_000
    assert ranked.agg({"rank": "max"}).first()[0] == 15_000 and ranked.select("rank").distinct().count() == 15_000
    assert ranked.agg({"score": "min"}).first()[0] >= out.filter("rank is null").agg({"score": "max"}).first()[0]


@pytest.mark.parametrize("share", [0, 10, 100])
def test_empty_tables(spark, read_docs, no_docs, share):  # noqa: F811
    none = spark.createDataFrame([], "text string")
    assert R.resample(no_docs, none, share_percent=share).count() == 0
    got = R.resample(read_docs, none, share_percent=share)
    n_fit = got.filter("n_words >= 20").count()
    assert got.count() == read_docs.count() and got.filter("rank is not null").count() == share * n_fit // 100
