"""Findings of the last review, each on the smallest input that shows it."""

import pictures
import json
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.images import image_problem
from tessera.operators import ingest as I
from tessera.operators import order as O
from tessera.operators import sequence as S
from tessera.sinks import shards as SH
from tessera.sources.records import read_cot
from tessera.sources.registry import Registry, load_mixture


def test_text_key_with_payload_has_every_index_once(spark):
    n = 400_000
    df = spark.range(n, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("k"), F.repeat(F.lit("x"), 20).alias("payload"))
    out = O.global_index(df, ["k"])
    r = out.agg(F.countDistinct("gi").alias("d"), F.min("gi").alias("lo"), F.max("gi").alias("hi")).first()
    assert (r["d"], r["lo"], r["hi"]) == (n, 0, n - 1)
    low = [x["k"] for x in out.filter("gi < 50").orderBy("gi").collect()]
    assert low == sorted(low)


@pytest.mark.parametrize("values", [[3.0, math.inf, -math.inf, None, 1.0, math.nan], [2.0, 2.0, 2.0]])
def test_odd_numeric_keys_in_both_directions(spark, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k double, i long")
    for key in ("k", F.col("k").desc(), F.col("k").asc_nulls_last()):
        got = [r["i"] for r in O.global_index(df, [key, "i"]).orderBy("gi").collect()]
        assert got == [r["i"] for r in df.orderBy(key, "i").collect()]


def test_few_values_of_the_first_key_are_split(spark):
    df = spark.range(100_000).select((F.col("id") % 2).alias("k"), "id")
    out = O.global_index(df, ["k", "id"], num_ranges=16)
    assert out.agg(F.countDistinct("gi")).first()[0] == 100_000
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 20_000


RECORDS = [{"task_id": 1, "gt": "a", "pred": "a", "cot_text": "x"}, {"task_id": 2, "gt": "b", "pred": "b", "cot_text": "y"}]


def test_records_by_path_uri_folder(spark, tmp_path):
    for kind, text in (("array", json.dumps(RECORDS, indent=2)), ("lines", "\n".join(map(json.dumps, RECORDS)))):
        folder = tmp_path / kind
        folder.mkdir()
        (folder / "r.json").write_text("\n" + text)
        for path in (str(folder / "r.json"), f"file://{folder}/r.json", str(folder), f"{folder}/*.json"):
            assert sorted(r["task_id"] for r in read_cot(spark, path).collect()) == [1, 2]


def test_records_that_do_not_parse_fail(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(RECORDS[0]) + "\n" + json.dumps({"task_id": "x1"}))
    with pytest.raises(Exception):
        read_cot(spark, str(tmp_path / "r.json")).collect()


def test_mixture_takes_shards_by_number(spark, tmp_path):
    out = str(tmp_path / "ds")
    SH.write_shards(spark.range(150), out, ["id"], samples_per_file=10)
    reg = Registry()
    reg.register("t", "d", data_dir=out)
    mix = load_mixture(spark, reg, {"t": {"dataset_names": ["d"], "num_used_data": [3]}})
    assert sorted(r["id"] for r in mix.collect()) == list(range(30))
    with pytest.raises(ValueError):
        load_mixture(spark, reg, {"t": {"dataset_names": ["d", "d"], "num_used_data": [3]}})


def test_empty_shards(spark, tmp_path):
    manifest = SH.write_shards(spark.range(0), str(tmp_path / "none"), ["id"])
    assert manifest.count() == 0
    totals = spark.read.json(str(tmp_path / "none_manifest" / "totals")).first()
    assert (totals["num_files"], totals["total_samples"]) == (0, 0)


def test_long_records_take_little_time(spark):
    import time

    text = "<image>a.png</image>" * 32_000
    df = spark.createDataFrame([(text,)], "t string").select(T.entries(T.segments("t")).alias("e"))
    start = time.time()
    entries = df.collect()[0]["e"]
    assert time.time() - start < 10
    assert [e["index"] for e in entries] == list(range(32_000))


GOOD = '[{"type": "text", "content": "a"}, {"type": "image", "index": 0, "content": null}]'
BAD = [GOOD.replace('"', "'"), GOOD + " x", GOOD + "]", GOOD[1:-1], '{"type": "text"}', GOOD.replace("0", '"0"'), GOOD.replace('"a"', "5"), "", "[", "5", GOOD + "," + GOOD]


def test_interleave_text_must_be_one_well_typed_array(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([GOOD, "[]", None, *BAD])], "i long, s string")
    got = {r["i"]: r["p"] for r in df.select("i", S.parse_interleave("s").alias("p")).collect()}
    assert [tuple(e) for e in got[0]] == [("text", "a", None), ("image", None, 0)]
    assert got[1] == [] and got[2] is None
    assert all(got[i] is None for i in range(3, 3 + len(BAD)))


def test_accepted_row_without_text_has_an_empty_sequence(spark):
    blank = '[{"type": "text", "content": "  "}]'
    a = spark.createDataFrame([("r", "yes", blank, blank, [], [])],
                              "id string, answer string, question_interleave string, solution_interleave string, question_images array<binary>, solution_images array<binary>")
    plan = S.sequence_plan(S.unify_layout_a(a))
    assert [(r["key"], r["sequence"]) for r in plan.collect()] == [("r", [])]
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_null_option_keeps_its_line(spark):
    df = spark.createDataFrame([({"B": "x", "A": None},)], "o map<string,string>")
    assert df.select(I.options_text("o").alias("t")).first()["t"] == "A: None\nB: x"


def test_image_end_markers_and_bitmaps(spark):
    png = pictures.png(b"body")
    rows = [("png", png), ("png_more", png + b"\n"), ("jpeg_more", b"\xff\xd8\xff\xe0x\xff\xd9\x00\x00"), ("cut", png[:-6]),
            ("bm_text", b"BM is a text of some length"), ("bmp", pictures.bmp())]
    df = spark.createDataFrame([(n, bytearray(b)) for n, b in rows], "n string, b binary")
    got = {r["n"]: r["p"] for r in df.select("n", image_problem("b").alias("p")).collect()}
    assert got == {"png": None, "png_more": None, "jpeg_more": None, "cut": "truncated", "bm_text": "unknown_format", "bmp": None}


def test_split_integrity_scans_once(spark):
    full = spark.range(100)
    split = full.withColumn("split", F.when(F.col("id") < 90, "train").otherwise("test"))
    got = {r["metric"]: r["value"] for r in O.split_integrity(split.union(split.filter("id = 5").withColumn("split", F.lit("test"))).filter("id <> 7"), full, "id").collect()}
    assert got == {"n_total": 100, "n_train": 89, "n_test": 11, "n_overlap": 1, "n_missing": 1, "n_extra": 1}


def _image_source(spark):
    return spark.createDataFrame([(p, bytearray(pictures.png(p.encode()))) for p in ("a.png", "b.png", "c.png")], "path string, content binary")


DOUBLE = [(1, "x", "x", "q <image>a.png</image> s"), (1, "y", "y", "r <image>b.png</image> s"), (1, "y", "y", "r <image>b.png</image> s"),
          (None, "z", "z", "n <image>c.png</image>"), (1, "w", "w", "m <image>gone.png</image>")]


def test_records_with_equal_or_missing_ids_keep_their_own_images(spark):
    records = spark.createDataFrame(DOUBLE, "task_id long, gt string, pred string, cot_text string")
    images = _image_source(spark)
    index = images.select("path", F.lit(True).alias("valid"))
    got = sorted((r["id"], r["answer"], pictures.note(r["question_images"][0])) for r in I.to_layout_a(records, images).collect())
    assert got == [("task_1", "x", b"a.png"), ("task_1", "y", b"b.png"), ("task_1", "y", b"b.png"), ("task_None", "z", b"c.png")]
    assert all(len(r["question_images"]) + len(r["solution_images"]) == 1 for r in I.to_layout_a(records, images).collect())
    for status in (I.status_a, I.status_b):
        counts = {r["status"]: r["n"] for r in I.ingest_report(status(records, index)).collect()}
        assert counts["ok"] == 4 and sum(counts.values()) == 5
    options = spark.createDataFrame([], "task_id long, options map<string,string>")
    rows = I.to_layout_b(records, images, options).collect()
    assert sorted((r["answer"], pictures.note(r["question_images"][0]["bytes"])) for r in rows) == [
        ("x", b"a.png"), ("y", b"b.png"), ("y", b"b.png"), ("z", b"c.png")]


def test_token_job_takes_a_tokenizer_and_epochs(spark, tmp_path):
    from tessera.operators import tokens as TK
    from tessera.plans import jobs

    entry = "array<struct<content: string, index: long, type: string>>"
    rows = [(i, [(f"text {'a' * i}", None, "text")], [("end", None, "text")]) for i in range(12)]
    spark.createDataFrame(rows, f"task_id long, question_interleave {entry}, solution_interleave {entry}").write.parquet(str(tmp_path / "in"))
    order = {}
    for epoch in (None, 0, 1):
        out = str(tmp_path / f"out{epoch}")
        jobs.write_token_batches(spark, str(tmp_path / "in"), out, tokenize=TK.pandas_tokenizer(lambda t: [ord(c) for c in t]), epoch=epoch)
        back = spark.read.parquet(out).orderBy("batch_id", "row_in_batch").collect()
        assert ord("a") in back[-1]["input_ids"] + back[0]["input_ids"]
        order[epoch] = [r["task_id"] for r in back]
    assert order[None] == list(range(12)) and sorted(order[0]) == order[None]
    assert order[0] != order[1] != order[None]


def test_split_job_writes_many_files(spark, tmp_path):
    import os

    from tessera.plans import jobs

    spark.range(4000).withColumnRenamed("id", "task_id").write.parquet(str(tmp_path / "in"))
    got = {r["split"]: r["num_samples"] for r in jobs.split_dataset(spark, str(tmp_path / "in"), str(tmp_path / "out"), ordered=True).collect()}
    assert got == {"train": 3600, "test": 400}
    in_place = {r["split"]: r["num_samples"] for r in jobs.split_dataset(spark, str(tmp_path / "in"), str(tmp_path / "cut")).collect()}
    assert in_place == got  # each task writes its own rows
    n = len([f for f in os.listdir(tmp_path / "out" / "split=train") if f.endswith(".parquet")])
    assert n >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 2


MALFORMED = [
    ("ok", GOOD, "ok"), ("single", BAD[0], "bad_json"), ("trailing", BAD[1], "bad_json"), ("object", '{"type": "text"}', "bad_json"),
    ("index", GOOD.replace("0", '"0"'), "bad_json"), ("content", GOOD.replace('"a"', "5"), "bad_json"), ("none", "[]", "untrainable"),
    ("no_type", '[{"content": "a"}]', "entry_without_type"), ("range", GOOD.replace("0", "3"), "index_out_of_bounds"),
]


def test_reasons_of_malformed_entries(spark):
    png = bytearray(pictures.png(b"x"))
    rows = [(n, "yes", s, '[{"type": "text", "content": "end"}]', [png], []) for n, s, _ in MALFORMED]
    a = spark.createDataFrame(rows, "id string, answer string, question_interleave string, solution_interleave string, "
                                    "question_images array<binary>, solution_images array<binary>")
    got = {r["key"]: r["reason"] for r in S.with_reject_reason(S.unify_layout_a(a)).collect()}
    assert got == {n: reason for n, _, reason in MALFORMED}
