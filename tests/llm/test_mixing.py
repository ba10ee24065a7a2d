from collections import defaultdict

import pytest

from conftest import SF_SMALL
from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import mixing, queries


def _targets(sizes, weights=(5, 2, 1), cap=3):
    """Reshare by weight until no target is above its cap."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > cap * sizes[s]}
        if not over:
            return {**out, **{s: unit * weight[s] for s in free}}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= over
    return out


def _check(docs, mix):
    rows = mix.taken().collect()
    assert len(rows) == docs.count()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s, want in _targets(size).items():
        assert abs(target[s] - want) < 1e-6 * max(1, want)
        assert taken[s] == int(target[s] + 1e-9) or abs(taken[s] - target[s]) <= 1
    return {(r["doc_id"], r["row"]): r["taken"] for r in rows}


def test_query_reaches_its_targets_again_and_again(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    assert _check(docs, mixing.Mix(docs)) == _check(docs, mixing.Mix(docs))


def test_odd_cases(read_docs, no_docs, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 50)
    monkeypatch.setattr(mixing.sizing, "rows_per_part", lambda *_: 5)
    for block in (None, 7, 100_000):
        _check(read_docs, mixing.Mix(read_docs, block=block))
    assert mixing.Mix(no_docs).taken().count() == 0


def test_sources_that_stop_at_their_cap(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(3, "a"), (50, "b"), (200, "c"), (0, "d"), (7, "é"), (400, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    _check(docs, mixing.Mix(docs))
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    _check(nothing, mixing.Mix(nothing))


def test_schedule_spreads_sources(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    mix = mixing.Mix(docs)
    rows = mix.schedule.orderBy("place").collect()
    total = defaultdict(int)
    for r in rows:
        assert r["rank"] == total[r["sid"]]
        total[r["sid"]] += 1
    half = defaultdict(int)
    for r in rows[: len(rows) // 2]:
        half[r["sid"]] += 1
    assert all(abs(half[s] - n / 2) <= 20 + 0.02 * n for s, n in total.items())


def test_mixed_documents_hold_what_was_taken(read_docs, no_docs):
    out = mixing.mixed_documents(read_docs)
    assert out.columns == read_docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["source"]] += len(r["text"].encode().split())
    taken = defaultdict(int)
    for r in mixing.Mix(read_docs).taken().collect():
        taken[r["source"]] += r["taken"]
    assert dict(words) == {s: n for s, n in taken.items() if n}
    assert mixing.mixed_documents(no_docs).count() == 0


def test_placed_words_are_the_taken_ones_in_even_shares(spark):
    mix = mixing.Mix(queries.table(spark, SF_SMALL, "documents"), block=64)
    rows = sorted(mix.placed().collect(), key=lambda r: (r["place"], r["at"]))
    words, in_place = defaultdict(int), defaultdict(dict)
    for r in rows:
        assert 0 <= r["from"] < r["until"]
        words[r["row"]] += r["until"] - r["from"]
        in_place[r["place"]][r["source"]] = in_place[r["place"]].get(r["source"], 0) + r["until"] - r["from"]
    assert words == {r["row"]: r["taken"] for r in mix.taken().collect() if r["taken"]}
    assert all(len(x) == 1 and sum(x.values()) <= 64 for x in in_place.values())
    order = [next(iter(in_place[p])) for p in sorted(in_place)]
    step = len(order) // 8
    for k in range(8):
        stretch = order[k * step:(k + 1) * step]
        for source in set(order):
            assert abs(stretch.count(source) - step * order.count(source) / len(order)) <= 0.05 * step + 8


def _plain_mix(mix):
    """What the mix takes of each row, and its first place, place by place."""
    rows = sorted((r["sid"], r["at"], r["size"], r["row"]) for r in mix.tape.collect())
    sources = sorted((r["sid"], r["source_size"], int(r["target"])) for r in mix.sources.collect() if r["source_size"] > 0)
    b = mix.block
    runs = []
    for sid, size, words in sources:
        n = words // size * -(-size // b) + -(-(words % size) // b)
        if n:
            runs.append([sid, size, words, n])
    total = sum(r[3] for r in runs)
    bits = (2 * total - 1).bit_length() if total else 0
    points, upto, taken, first = 1 << bits, 0, {}, {}
    for r in runs:
        r += [-(-upto * points // total), -(-(upto + r[3]) * points // total), 0]
        upto += r[3]
    for place in range(points if total else 0):
        point = int(format(place, f"0{bits}b")[::-1], 2) if bits else 0
        r = next((r for r in runs if r[4] <= point < r[5]), None)
        if r is None:
            continue
        sid, size, words, n, _, _, rank = r
        r[6] += 1
        if rank >= n:
            continue
        blocks = -(-size // b)
        begin = rank % blocks * b
        end = min(begin + b, size if rank // blocks < words // size else words % size)
        for s, at, length, row in rows:
            got = min(end, at + length) - max(begin, at)
            if s == sid and length and got > 0:
                taken[row] = taken.get(row, 0) + got
                first.setdefault(row, place)
    return taken, first


@pytest.mark.parametrize("block, seed", [(7, 1), (64, 2), (1000, 3)])
def test_taken_and_places_equal_a_plain_mix(spark, tmp_path, block, seed):
    path = str(tmp_path / "docs")
    spark.range(60).selectExpr("id as doc_id", "if(id % 7 = 0, null, concat('s', id % 4)) as source",
                               "repeat('word ', cast(pmod(xxhash64(id), 40) as int)) as text").repartition(3).write.parquet(path)
    mix = mixing.Mix(spark.read.parquet(path), block=block, seed=seed)
    taken, first = _plain_mix(mix)
    got = mix.taken().collect()
    assert len(got) == 60 and sum(taken.values()) > 0
    assert {r["row"]: (r["taken"], r["first_place"]) for r in got} == {r["row"]: (taken.get(r["row"], 0), first.get(r["row"])) for r in got}
