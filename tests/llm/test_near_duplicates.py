import random
from collections import defaultdict

import numpy as np

from conftest import SF_SMALL
from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import near_duplicates as N
from tessera.llm import queries
from tessera.llm.components import components


def _write(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_query_matches_all_pairs(spark):
    docs = [(r[0], r[1]) for r in queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.op5_near_duplicates(spark, SF_SMALL).collect()}
    assert got == N.brute_force(docs)


def _edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return " ".join(words)


def test_groups_around_one_origin_and_chains(spark, tmp_path, monkeypatch):
    """Copies near the limit of one origin, links that no star finds, chains,
    and copies too far away; buckets cut into several blocks."""
    monkeypatch.setattr(N, "BLOCK_CHARS", 4000)
    rng = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(10**9)}" for _ in range(200)]
        for _ in range(25):
            rows.append((len(rows), _edited(rng, base, rng.choice([1, 2, 3, 4, 5, 6, 8]))))
        chain = base
        for _ in range(12):
            chain = _edited(rng, chain, 3).split(" ")
            rows.append((len(rows), " ".join(chain)))
        rows += [(len(rows) + k, rows[-1][1]) for k in range(3)]
    got = {r["doc_id"]: r["class_id"] for r in N.classes(_write(spark, tmp_path / "d", rows)).collect()}
    assert got == N.brute_force(rows)


def test_signatures_agree_as_the_weighted_similarity():
    rng = random.Random(1)
    a = [f"x{i}" for i in range(300)]
    left = " ".join(a + a[:150] + ["z y x w v"] * 9)
    right = " ".join(_edited(rng, a, 12).split() + a[:100] + ["z y x w v"] * 5)
    want = N.similarity(left, right)
    agree = []
    for salt in range(40):
        bags = []
        for text in (left, right):
            data = np.frombuffer(text.encode(), np.uint8)
            bags.append(N.bags(0, data, np.array([0, len(data)])))
        sigs = [N.signatures(1, r, N.wordhash.mix64(h + np.uint64(salt)), w)[0] for r, h, w in bags]
        agree.append((sigs[0] == sigs[1]).mean())
    assert abs(np.mean(agree) - want) < 0.03


def test_multiplicities_count():
    assert N.similarity("a b c d e " * 4, "a b c d e " * 4) == 1.0
    assert N.similarity("a b c d e " * 4, "a b c d e " * 8) < 0.6
    assert N.similarity("one two", "one two") == 1.0


def test_odd_cases(read_docs, no_docs):
    rows = N.classes(read_docs).collect()
    assert len(rows) == read_docs.count()
    by_text = defaultdict(set)
    text = {}
    for r in read_docs.select("doc_id", "text").collect():
        text.setdefault(r["doc_id"], r["text"])
    keys = defaultdict(list)
    for r in rows:
        keys[r["class_key"]].append(r)
        if r["doc_id"] in (9, 10, 7, 8):
            by_text[r["doc_id"]].add(r["class_id"])
    assert by_text[9] == by_text[10] == {9} and by_text[7] == by_text[8] == {7}
    assert all(sum(r["first"] for r in g) == 1 and all(r["class_size"] == len(g) for r in g) for g in keys.values())
    assert N.classes(no_docs).count() == 0
    kept = N.one_of_each(read_docs)
    assert kept.columns == read_docs.columns and kept.count() == len(keys)
    assert sorted(r["doc_id"] for r in kept.collect() if r["text"] is None and r["doc_id"] is not None) == [3]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    edges = chain[::-1] + star + [(60, 60), (70, 71), (71, 70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 70: 70, 71: 70}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _tasks(spark, group, job):
    """Tasks of all stages that ``job`` runs."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        result = job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return result, sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)


def test_tasks_follow_the_rows_and_not_the_shuffle_partitions(spark, tmp_path):
    """Where no setting of the session joins small partitions, a round over few
    edges still takes few tasks."""
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**9)}" for _ in range(80)]
    rows = [(i, _edited(rng, base, rng.choice([1, 2, 3]))) for i in range(30)]
    docs = _write(spark, tmp_path / "d", rows)
    graph = spark.createDataFrame(edges, "a long, b long")
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got, of_components = _tasks(spark, "few edges", lambda: {r["node"]: r["component"] for r in components(graph).collect()})
        found, of_classes = _tasks(spark, "few documents", lambda: {r["doc_id"]: r["class_id"] for r in N.classes(docs).collect()})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}
    assert found == N.brute_force(rows)
    assert of_components < 60 * 12 and of_classes < 60 * 40
