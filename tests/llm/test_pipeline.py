from conftest import SF_SMALL

import corpus_pipeline
from tessera.llm import mixing, near_duplicates, personal_data, quality, queries


def test_stages_one_by_one(spark, tmp_path):
    docs = queries.table(spark, SF_SMALL, "documents")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], SF_SMALL)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    start, good, single, masked, mixed = frames
    rows = lambda df: {(r["doc_id"], r["text"]) for r in df.collect()}

    labels = queries.table(spark, SF_SMALL, "labels")
    kept = {r["doc_id"] for r in quality.judge(start, labels).filter("kept").collect()}
    assert rows(good) == {x for x in rows(start) if x[0] in kept}

    classes = near_duplicates.brute_force([(r["doc_id"], r["text"]) for r in good.collect()])
    assert rows(single) == {x for x in rows(good) if classes[x[0]] == x[0]}

    assert rows(masked) == {(d, personal_data._masked(t)) for d, t in rows(single)}
    assert not any(x[0] in ("email", "card", "phone", "ip") for _, t in rows(masked) for x in personal_data.find_spans(t))
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())

    taken = {r["doc_id"]: r["taken"] for r in mixing.Mix(masked).taken().collect()}
    got = dict.fromkeys(taken, 0)
    for r in mixed.collect():
        got[r["doc_id"]] += len(r["text"].encode().split())
    assert got == taken

    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, SF_SMALL)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_run_gives_rows(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
