import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import blocks, queries
from tessera.llm import phrase_mining as P

LOW = {i: i + 32 for i in range(65, 91)}


def _pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def _counts(docs, max_words):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in _pieces(text):
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    return f, n


def _plain(docs, min_count=30, max_words=4, top=2000, covered=80, scale=2_000_000):
    """The definition, phrase by phrase."""
    f, n = _counts(docs, max_words)
    f = {k: c for k, c in f.items() if c >= min_count}
    rows = {}
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        if any(l2 == lang and len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in f.items()):
            continue
        score, _, l, r = min((scale * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, l, r, score))
    return sorted((lang, i + 1, x[2].decode(), *x[3:6], n[lang], x[6]) for lang, xs in rows.items() for i, x in enumerate(sorted(xs)[:top]))


def _some_docs(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = ["Aa", "b", "c", "dé", "é", "x.y", "ü v", "E"]
    out = []
    for i in range(n):
        words = [vocabulary[min(int(rnd.expovariate(0.6)), 7)] for _ in range(rnd.randint(0, 40))]
        out.append((rnd.choice(["en", "fr", None, "und"]), "".join(w + rnd.choice([" ", "  ", "\t", ", ", "\n", " "]) for w in words)))
    return out


@pytest.mark.parametrize("shards, filter_bits, max_words, min_count", [(3, 25, 4, 5), (1, 20, 4, 5), (5, 20, 3, 8), (3, 6, 4, 5)])
def test_equals_the_definition(spark, tmp_path, shards, filter_bits, max_words, min_count):
    docs = _some_docs(shards)
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, lang, 1, 2) for i, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string, shard int, n int").repartition(4).write.parquet(path)
    got = P.collocations(spark.read.parquet(path), min_count, max_words, top=15, shards=shards, filter_bits=filter_bits).collect()
    assert sorted(map(tuple, got)) == _plain(docs, min_count, max_words, top=15)
    assert len(got) > 20


def test_counts_are_whole(spark, tmp_path):
    """Also for phrases that reach the count in the last shard they meet."""
    docs = [("en", "p q r s. ")] * 30 + _some_docs(9) + [("en", " ".join(f"u{i} v{i} w{i} z{i};" for i in range(40)))] * 31
    path = str(tmp_path / "docs")
    spark.createDataFrame(docs, "lang string, text string").repartition(5).write.parquet(path)
    got = {(r["lang"], r["phrase"]): r["n"] for r in P.frequent_phrases(spark.read.parquet(path)).filter("words > 0").collect()}
    want, _ = _counts(docs, 4)
    assert got == {(lang, " ".join(p)): c for (lang, p), c in want.items() if c >= 30}
    assert got["en", "p q r s"] == 30


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB .,\té\n", max_size=60), min_size=1, max_size=5), st.integers(1, 20))
def test_stretches_lose_and_repeat_nothing(texts, limit):
    before = P.STRETCH_BYTES
    P.STRETCH_BYTES = limit
    try:
        found = Counter()
        batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
        for words, _, _ in P._words_of(batch, 3):
            for n, hashes, inside in words.runs(4):
                found.update(words.spelled((inside & words.new[n - 1:]).nonzero()[0], n))
        assert found == Counter({" ".join(p): c for (_, p), c in _counts([("en", t) for t in texts], 4)[0].items()})
    finally:
        P.STRETCH_BYTES = before


def test_bitmaps_and_buckets():
    import numpy as np

    h = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64))
    assert blocks.edges(h, 3).tolist() == [0, *(int((h < (b << 61)).sum()) for b in range(1, 8)), 500]
    bitmap = np.zeros(1 << 13, np.uint8)
    some = h[::7]
    at = (some >> np.uint64(48)).astype(np.int64)
    bitmap |= blocks.bits_of(blocks.bits_at(at, 1 << 16))
    told = blocks.look_up(blocks.interleaved(np.zeros_like(bitmap), bitmap), h)
    assert set((told & 1).tolist()) == {0}
    assert (told[::7] >> 8 & 1).all() and (told >> 8 & 1).sum() < 100
    distinct, sums = blocks.merged([h[::2], h[:0], h[::3]], [np.ones(250, np.uint64), h[:0], np.full(167, 5, np.uint64)])
    assert dict(zip(distinct.tolist(), sums.tolist())) == {x: (i % 2 == 0) + 5 * (i % 3 == 0) for i, x in enumerate(h.tolist()) if i % 2 == 0 or i % 3 == 0}
    assert [x.tolist() for x in blocks.unpack(blocks.pack(h, h[::-1].copy()), 2)] == [h.tolist(), h[::-1].tolist()]


def test_names_read_back():
    a, b = P.Names(), P.Names()
    a.add([2**64 - 1, 5, 7], ["en", "x\ny", ""], ["a b", "é", "w\x00"])
    b.read(a.pack())
    assert b.of == {2**64 - 1: ("en", "a b"), 5: ("x\ny", "é"), 7: ("", "w\x00")}


def test_large_counts_are_exact(spark):
    big = 4 * 10**18
    found = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7), ("en", 3, "a b c", 40), ("en", 1, "c", 41), ("en", 2, "b c", 60)],
                                  "lang string, words int, phrase string, n long")
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in P.scored(found).collect()}
    assert got["a b"] == (big, big + 1, 2_000_000 * (big - 7) // (2 * big + 1))
    assert got["a b c"] == (big, 60, 0)


def test_odd_cases(spark, read_docs, no_docs):  # noqa: F811
    docs = read_docs.withColumnRenamed("source", "lang")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, P.collocations(docs, 2).collect())) == _plain(rows, 2)
    assert P.collocations(no_docs.withColumnRenamed("source", "lang")).count() == 0


def test_query_equals_sql(spark):
    from conftest import SF_SMALL
    from harness import compare

    ok, _, _, detail = compare(spark, "op13", queries.op13_phrase_mining, queries.oracle_sql()["op13_phrase_mining"], SF_SMALL)
    assert ok, detail
