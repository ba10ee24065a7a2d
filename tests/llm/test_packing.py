import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def _ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


ODD = st.text(alphabet=st.sampled_from("ab \n\t\r\x0b  　\u0085 .,'s1é中\U0001f600"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(ODD, st.text(max_size=30), st.just("a <|endoftext|> b")), max_size=8))
def test_ids_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    texts = [x.encode("utf-8", "ignore").decode() for x in texts]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.token_ids(pa.array(texts, pa.string()), queries.tokenizer_path())]
    assert got == [_ids(t, x) for x in texts]


def _one_by_one(histogram, size):
    """Sequences of best fit decreasing over the pieces themselves."""
    room = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [r for r in room if r >= length]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - length)
            else:
                room.append(size - length)
    return len(room)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_fills_without_overlap(histogram):
    slots = packing.plan(histogram, 64)
    taken = defaultdict(list)
    ranks = defaultdict(list)
    for length, first, end, seq, each, offset in slots:
        for rank in range(first, end):
            ranks[length].append(rank)
            taken[seq + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for pieces in taken.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert len(taken) == _one_by_one(histogram, 64)


def _check(df, docs, tokenizer, max_tokens):
    rows = df.collect()
    expected = Counter()
    for doc_id, text in docs:
        ids = np.array([*_ids(tokenizer, text or ""), 2], "<u4")
        for k, (s, n) in enumerate(packing.cut_points(len(ids), max_tokens)):
            expected[(doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= max_tokens
    return len(sequences), Counter(r["length"] for r in rows)


def test_query_against_the_tokenizer(spark, tokenizer):
    from conftest import SF_SMALL

    docs = [(r[0], r[1]) for r in queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    n, histogram = _check(queries.op2_best_fit_packing(spark, SF_SMALL), docs, tokenizer, 1024)
    assert n <= 1.05 * packing.least_sequences(histogram) + 1


def test_odd_cases(read_docs, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in read_docs.collect()]
    _check(packing.pack(read_docs, queries.tokenizer_path(), max_tokens=50), docs, tokenizer, 50)


def test_parts_of_a_length_rank_gaplessly(spark, monkeypatch):
    monkeypatch.setattr(packing.sizing, "rows_per_part", lambda *_: 7)
    df = spark.range(300).selectExpr("id as doc_id", "id % 3 + 1 as length")
    got = defaultdict(list)
    for r in packing.ranked(df, {1: 100, 2: 100, 3: 100}).collect():
        got[r["length"]].append(r["rank"])
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(100)) for k in (1, 2, 3)}


def test_first_piece_takes_the_rest():
    assert packing.cut_points(10, 4) == [(0, 2), (2, 4), (6, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_points(3, 4) == [(0, 3)]


def test_empty_table(no_docs):
    assert packing.pack(no_docs, queries.tokenizer_path()).count() == 0


def test_sequences_hold_the_ids(read_docs, tokenizer):
    packed = packing.pack(read_docs, queries.tokenizer_path(), max_tokens=50).persist()
    expected, got = Counter(), Counter()
    for r in read_docs.collect():
        ids = [*_ids(tokenizer, r["text"] or ""), 2]
        for k, (s, n) in enumerate(packing.cut_points(len(ids), 50)):
            expected[(r["doc_id"], k, s, tuple(ids[s:s + n]))] += 1
    for r in packed.collect():
        got[(r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist()))] += 1
    assert got == expected
    whole = packing.sequences(packed).collect()
    assert len(whole) == packed.select("sequence_id").distinct().count()
    got = Counter()
    for r in whole:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 50
        assert [p["offset"] for p in r["pieces"]] == np.cumsum([0, *[p["length"] for p in r["pieces"]]])[:-1].tolist()
        for p in r["pieces"]:
            got[(p["doc_id"], p["piece"], p["start"], tuple(ids[p["offset"]:p["offset"] + p["length"]]))] += 1
    assert got == expected


def test_long_texts_come_in_stretches(tokenizer, monkeypatch):
    import random

    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["ab", "é", " ", " ", "  ", "\n", "　", "12", "'s", "中", "<|endoftext|>", ".", "\t"]) for _ in range(rnd.randint(50, 400))) for _ in range(40)]
    monkeypatch.setattr(packing, "CHUNK_BYTES", 37)
    monkeypatch.setattr(packing, "GROUP_BYTES", 80)
    monkeypatch.setattr(packing, "GATHERED_UNITS", 5)
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.token_ids(pa.array(texts), queries.tokenizer_path())]
    assert got == [_ids(tokenizer, x) for x in texts]


def test_memory_of_a_worker_is_bounded(tmp_path):
    """Short words, distinct words and one long text: the peak is that of a chunk."""
    import subprocess
    import sys

    code = f"""
import resource, sys
sys.path.insert(0, {packing.__file__.rsplit('/tessera/', 1)[0]!r})
import pyarrow as pa
from tessera.llm import packing, queries
path = queries.tokenizer_path()
list(packing.token_ids(pa.array(['warm up']), path))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text in ('a b c d ' * 1_400_000, ' '.join(f'w{{i * 7919}}' for i in range(1_000_000)), '中文 ' * 1_000_000):
    for batch in ([text], [text[i:i + 5_000] for i in range(0, len(text), 5_000)]):
        for ids in packing.token_ids(pa.array(batch), path):
            pass
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=600).stdout)
    assert grown < 350, grown  # of which the one long text, its list and its ids make about 100
