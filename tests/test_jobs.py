"""End-to-end jobs on real files built from the sf0.001 fixtures."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans import catalog as C
from tessera.plans import jobs
from tessera.sources import fixtures as X


def _materialise(spark, root):
    recs = [r.asDict() for r in X.cot_source(spark, SF_SMALL).collect()]
    with open(root / "records.jsonl", "w") as f:
        f.write("\n".join(json.dumps(r, ensure_ascii=False) for r in recs))
    for r in X.image_blobs(spark, SF_SMALL).collect():
        p = root / r.path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(bytes(r.content))
    for r in X.task_option_maps(spark, SF_SMALL).collect():
        d = root / f"task_{r.task_id}"
        d.mkdir(parents=True, exist_ok=True)
        (d / "data.json").write_text(json.dumps({"options": r.options}))
    return recs


def test_jobs_end_to_end(spark, tmp_path):
    root = tmp_path / "data"
    root.mkdir()
    _materialise(spark, root)
    src = str(root / "records.jsonl")

    report, manifest = jobs.convert_layout_a(spark, src, str(tmp_path / "a"), str(root), samples_per_file=5)
    expected_a = C.layout_a_rows(spark, SF_SMALL)
    got_a = spark.read.parquet(str(tmp_path / "a"))
    key = lambda r: (r.id, r.question_interleave, r.solution_interleave, tuple(map(bytes, r.question_images)),
                     tuple(map(bytes, r.solution_images)))
    assert sorted(map(key, got_a.drop("gi", "shard_id").collect())) == sorted(map(key, expected_a.collect()))
    assert manifest.agg(F.sum("num_samples")).collect()[0][0] == expected_a.count()
    counts = {r.status: r.n for r in report.collect()}
    assert counts["ok"] == expected_a.count()

    info = jobs.convert_layout_b(spark, src, str(root), str(tmp_path / "b")).collect()[0]
    assert info.num_samples == C.layout_b_rows(spark, SF_SMALL).count()
    got_b = spark.read.parquet(str(tmp_path / "b" / "train"))
    exp_b = C.layout_b_rows(spark, SF_SMALL)
    kb = lambda r: (r.task_id, json.dumps([x.asDict() for x in r.question_interleave]),
                    json.dumps([x.asDict() for x in r.solution_interleave]), len(r.solution_images))
    assert sorted(map(kb, got_b.collect())) == sorted(map(kb, exp_b.collect()))

    split = {r.split: r.num_samples for r in jobs.split_dataset(spark, str(tmp_path / "b" / "train"), str(tmp_path / "s")).collect()}
    n = info.num_samples
    assert split == {"train": int(n * 0.9), "test": n - int(n * 0.9)}
    doc = jobs.parquet_info(spark, str(tmp_path / "s" / "split=train")).collect()
    assert sum(v.num_rows for v in doc) == int(n * 0.9)
    assert os.path.isdir(str(tmp_path / "s_info"))


def test_sequence_and_token_jobs(spark, tmp_path):
    from tessera.operators import sequence as S

    a = C.layout_a_rows(spark, SF_SMALL)
    b = C.layout_b_rows(spark, SF_SMALL)
    a.write.parquet(str(tmp_path / "a"))
    b.write.parquet(str(tmp_path / "b"))
    reasons = {r.reason: r.n for r in jobs.write_sequences(spark, str(tmp_path / "a"), str(tmp_path / "seq")).collect()}
    seqs = spark.read.parquet(str(tmp_path / "seq"))
    assert seqs.count() == reasons.get(S.REASON_OK, 0) and sum(reasons.values()) == a.count()
    stats = jobs.write_token_batches(spark, str(tmp_path / "b"), str(tmp_path / "tok"), batch_size=4,
                                     max_tokens=10_000).collect()[0]
    n = b.count()
    assert stats.num_rows == n and stats.num_batches == -(-n // 4)
    got = spark.read.parquet(str(tmp_path / "tok"))
    want = C.all_queries()["padded_batches"](spark, SF_SMALL)
    assert sorted(r.input_ids for r in got.select(F.array_join("input_ids", ",").alias("input_ids")).collect()) == \
        sorted(r.input_ids for r in want.select("input_ids").collect())


def test_cli_parquet_info(spark, capsys):
    jobs.main(["parquet-info", "--input", f"{SF_SMALL}/orders.parquet"])
    out = capsys.readouterr().out
    assert "orders.parquet" in out and "1500" in out
