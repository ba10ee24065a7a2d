import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from conftest import SF_SMALL
from llm_fixtures import no_docs, odd_docs, read_docs, some_labels  # noqa: F401
from tessera.llm import quality, queries

MASK = (1 << 64) - 1


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else (value & MASK).to_bytes(8, "little")
    return _signed(xxhash.xxh64_intdigest(data, seed=seed & MASK))


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _grams(text, buckets):
    h = [_hash(w) for w in _words(text)]
    return [x % buckets for x in h] + [_hash(b, seed=_hash(a)) % buckets for a, b in zip(h, h[1:])]


def _features(text):
    text = text or ""
    words = _words(text)
    lines = [x for x in text.split("\n") if _words(x)]
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            n < 20 or 100 * len(repeated) > 30 * n)


def _brute(docs, labels, threshold, buckets, max_target):
    good = sorted({d for d, q, t in labels if q == 1 and t != 1 and d is not None}, key=lambda d: (_hash(d), d))[:max_target]
    grams = [_grams(t, buckets) for _, t in docs]
    raw = Counter(g for x in grams for g in x)
    target = Counter(g for (d, _), x in zip(docs, grams) if d in set(good) for g in x)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = [0.0] * buckets
    if n_target:
        share = [(raw[b] + 1) / (n_raw + buckets) for b in range(buckets)]
        prior = quality.PRIOR_PER_BUCKET * buckets
        weight = [math.log((target[b] + prior * share[b]) / (n_target + prior) / share[b]) for b in range(buckets)]
    out = []
    for (d, t), x in zip(docs, grams):
        f = _features(t)
        score = sum(weight[g] for g in x) / len(x) if x else 0.0
        out.append((d, *f, not f[5] and score >= threshold, score))
    return out


def _compare(df, expected):
    got = [tuple(r) for r in df.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert a[:8] == b[:8]
        assert a[8] == pytest.approx(b[8], abs=1e-9)


def _labels(df):
    return [tuple(r) for r in df.select("doc_id", "quality", "toxic").collect()]


def test_query_matches_brute_force(spark):
    docs = [(r[0], r[1]) for r in queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    labels = _labels(queries.table(spark, SF_SMALL, "labels"))
    _compare(queries.op1_quality_rules(spark, SF_SMALL), _brute(docs, labels, quality.THRESHOLD, quality.BUCKETS, quality.MAX_TARGET))


def test_odd_cases_and_bounded_target(read_docs, some_labels):
    docs = [(r["doc_id"], r["text"]) for r in read_docs.collect()]
    judged = quality.judge(read_docs, some_labels, threshold=-0.05, buckets=64, max_target=2).select("doc_id", *quality.FEATURES)
    _compare(judged, _brute(docs, _labels(some_labels), -0.05, 64, 2))


def test_without_target_only_the_base_rules_reject(read_docs, some_labels):
    rows = quality.judge(read_docs, some_labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0.0 for r in rows)


def test_kept_documents_are_unchanged_rows(read_docs, some_labels, no_docs):
    judged = quality.judge(read_docs, some_labels)
    kept = quality.kept_documents(read_docs, some_labels)
    assert kept.columns == read_docs.columns
    assert kept.count() == judged.filter("kept").count()
    assert {r["n_words"] for r in kept.collect()} == {5}
    assert quality.kept_documents(no_docs, some_labels).count() == 0


def test_labelled_documents_separate(spark):
    """Good documents of 20 words or more stay, most bad ones go."""
    sf = "/root/testdata/sf0.01"
    labels = queries.table(spark, sf, "labels")
    rows = queries.op1_quality_rules(spark, sf).join(labels, "doc_id").select("quality", "kept", "n_words").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["n_words"] >= 20]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.4 * len(bad)


@pytest.mark.parametrize("one_in, most_bad_kept", [(50, 0.75), (10, 0.4)])
def test_held_out_good_documents_stay(spark, one_in, most_bad_kept):
    """The target is a part of the labels; the others are judged by it."""
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    given = labels.filter(f"pmod(xxhash64(doc_id, 5), {one_in}) = 0")
    judged = quality.judge(docs, given).select("doc_id", "kept", "base_failed").join(labels.join(given, "doc_id", "left_anti"), "doc_id")
    rows = judged.filter("not base_failed").select("quality", "toxic", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] != 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(good) > 2000 and sum(good) >= 0.95 * len(good)
    assert sum(bad) <= most_bad_kept * len(bad)


def test_no_python_in_the_plan(spark):
    plan = queries.op1_quality_rules(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
