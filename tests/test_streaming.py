"""Incremental ingest: arriving JSON Lines files become layout-A rows."""

import json

import pictures
from pyspark.sql import functions as F

from tessera.streaming.ingest import finish_waiting, start_layout_a_ingest


def test_stream_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    recs = [
        {"task_id": 1, "gt": "A", "pred": "A", "cot_text": "<image>p1</image> step one <image>p2</image> done"},
        {"task_id": 2, "gt": "A", "pred": "B", "cot_text": "<image>p1</image> x"},
        {"task_id": 3, "gt": "C", "pred": "C", "cot_text": "no images"},
    ]
    (src / "a.jsonl").write_text("\n".join(json.dumps(r) for r in recs))
    png = pictures.png(b"z")
    images = spark.createDataFrame([("p1", png), ("p2", png)], "path string, content binary")
    out = str(tmp_path / "out")
    q = start_layout_a_ingest(spark, str(src), images, out, checkpoint=str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(f"{out}/rows").collect()
    assert [r.id for r in rows] == ["task_1"] and len(rows[0].solution_images) == 1
    status = {r.status: r.n for r in spark.read.parquet(f"{out}/_status").groupBy("status").agg(F.sum("n").alias("n")).collect()}
    assert status == {"ok": 1, "mismatch": 1, "other": 1}


def test_stream_ingest_is_incremental(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    png = pictures.png(b"z")
    images = spark.createDataFrame([("p1", png)], "path string, content binary")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def arrive(name, task_ids):
        recs = [{"task_id": t, "gt": "A", "pred": "A", "cot_text": f"<image>p1</image> step {t}"} for t in task_ids]
        (src / name).write_text("\n".join(json.dumps(r) for r in recs))

    arrive("a.jsonl", [1, 2])
    start_layout_a_ingest(spark, str(src), images, out, checkpoint=ckpt, trigger_once=True).awaitTermination(120)
    arrive("b.jsonl", [3])
    start_layout_a_ingest(spark, str(src), images, out, checkpoint=ckpt, trigger_once=True).awaitTermination(120)
    rows = spark.read.parquet(f"{out}/rows")
    assert sorted(r.id for r in rows.collect()) == ["task_1", "task_2", "task_3"]
    assert rows.select("batch_id").distinct().count() == 2


def test_records_wait_for_late_images(spark, tmp_path):
    """Images that come two batches later, too late, and never."""
    src, imgs = tmp_path / "in", tmp_path / "imgs"
    src.mkdir()
    imgs.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def batch(k, name, image):
        (src / f"{k}.jsonl").write_text(json.dumps({"task_id": k, "gt": "A", "pred": "A", "cot_text": f"<image>{name}</image> step" if name else "no image"}))
        if image:
            (imgs / image).write_bytes(pictures.png(image.encode()))
        start_layout_a_ingest(spark, str(src), str(imgs), out, checkpoint=ckpt, trigger_once=True, wait_batches=2).awaitTermination(120)

    batch(0, "late.png", None)
    batch(1, "too_late.png", None)
    batch(2, "never.png", "late.png")
    batch(3, "", None)
    batch(4, "last.png", "too_late.png")
    (imgs / "last.png").write_bytes(pictures.png(b"last"))
    finish_waiting(spark, str(imgs), out, 4)
    rows = {r["id"]: r["batch_id"] for r in spark.read.parquet(f"{out}/rows").select("id", "batch_id").collect()}
    assert rows == {"task_0": 2, "task_4": 5}
    status = {(r["batch_id"], r["status"]): r["n"] for r in spark.read.parquet(f"{out}/_status").collect()}
    assert status == {(0, "waiting"): 1, (1, "waiting"): 2, (2, "ok"): 1, (2, "waiting"): 2, (3, "other"): 2, (3, "waiting"): 1,
                      (4, "other"): 1, (4, "waiting"): 1, (5, "ok"): 1}
    assert sum(n for (_, s), n in status.items() if s != "waiting") == 5
