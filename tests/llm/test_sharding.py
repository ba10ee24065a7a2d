from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401

from conftest import SF_SMALL
from tessera.llm import queries, sharding


def _plain(shards, size):
    """Turn by turn over full preference lists."""
    prefer = {s: [(sharding._hash(s, "offset") + i * (sharding._hash(s, "skip") % (size - 1) + 1)) % size for i in range(size)] for s in shards}
    owner, at = {}, dict.fromkeys(shards, 0)
    while len(owner) < size:
        for s in sorted(shards):
            while len(owner) < size and prefer[s][at[s]] in owner:
                at[s] += 1
            if len(owner) < size:
                owner[prefer[s][at[s]]] = s
    return [owner[i] for i in range(size)]


@pytest.mark.parametrize("n,size", [(1, 2), (3, 7), (5, 101), (8, 1009)])
def test_table_is_filled_by_turns(n, size):
    shards = sharding.names(n)
    owner = sharding.lookup_table(shards, size)
    assert [shards[s] for s in owner] == _plain(shards, size)
    counts = Counter(owner.tolist())
    assert max(counts.values()) - min(counts[s] for s in range(n)) <= 1
    back = shards[::-1]
    assert [back[s] for s in sharding.lookup_table(back, size)] == [shards[s] for s in owner]


def test_few_slots_move_when_a_shard_goes():
    shards = sharding.names(20)
    a = np.array(shards)[sharding.lookup_table(shards, 10_007)]
    b = np.array(shards[:7] + shards[8:])[sharding.lookup_table(shards[:7] + shards[8:], 10_007)]
    stayed = a != shards[7]
    assert (a[stayed] != b[stayed]).mean() < 0.1


def test_wrong_tables_are_refused():
    for shards, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, size)


def _slot(value):
    data = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
    h = xxhash.xxh64_intdigest(data, seed=42)
    return (h - (1 << 64) if h >> 63 else h) % sharding.TABLE_SIZE


def _expected(rows):
    shards = sharding.names()
    owner = sharding.lookup_table(shards)
    slots = [(d, _slot(d) if d is not None else 42 % sharding.TABLE_SIZE if t is None else _slot(t)) for d, t in rows]
    return Counter((d, s, shards[owner[s]]) for d, s in slots)


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_query_matches_the_table(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    assert Counter(map(tuple, queries.op3_shard_lookup(spark, SF_SMALL).collect())) == _expected(_rows(docs))


def test_odd_cases(read_docs, no_docs, spark, tmp_path):
    assert Counter(map(tuple, sharding.place(read_docs).collect())) == _expected(_rows(read_docs))
    assert sharding.place(no_docs).count() == 0
    sharding.write(read_docs, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*read_docs.columns, "shard"])
    want = Counter((d, s) for (d, _, s), n in _expected(_rows(read_docs)).items() for _ in range(n))
    assert Counter((r["doc_id"], r["shard"]) for r in back.collect()) == want


def test_shards_are_even(spark):
    counts = queries.op3_shard_lookup(spark, "/root/testdata/sf0.1").groupBy("shard").count().collect()
    mean = 10_000 / sharding.SHARDS
    assert len(counts) == sharding.SHARDS and max(r["count"] for r in counts) < mean + 6 * mean**0.5


def test_write_keeps_a_column_named_shard(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", f"own{i}") for i in range(20)], "doc_id long, text string, shard string")
    sharding.write(df, str(tmp_path / "out"), ["x", "y"], 17)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.columns) == ["doc_id", "shard", "shard_", "text"]
    assert {(r["doc_id"], r["shard"]) for r in got.collect()} == {(i, f"own{i}") for i in range(20)}
    assert {r["shard_"] for r in got.collect()} == {"x", "y"}
