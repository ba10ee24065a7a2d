"""Round trips of sources and sinks in a temporary folder."""

import pictures
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import ingest as I
from tessera.operators.images import image_index
from tessera.plans import catalog as C
from tessera.sinks import files as K
from tessera.sinks import shards as SH
from tessera.sources.footers import dataset_footers, parquet_files, parquet_footers
from tessera.sources.images import read_images
from tessera.sources.records import read_cot, read_pairs, read_task_options
from tessera.sources.registry import Registry, load_mixture, lookup


def test_read_cot_array_and_lines(spark, tmp_path):
    recs = [{"task_id": 1, "gt": "A", "pred": "A", "cot_text": "<image>x</image>t"}, {"task_id": 2, "gt": "B"}]
    arr = tmp_path / "cot.json"
    arr.write_text(json.dumps(recs))
    lines = tmp_path / "cot.jsonl"
    lines.write_text("\n".join(json.dumps(r) for r in recs))
    a = sorted(read_cot(spark, str(arr)).collect())
    b = sorted(read_cot(spark, str(lines)).collect())
    assert a == b and len(a) == 2 and a[1].pred is None


def test_read_cot_folder_of_both_kinds_raises(spark, tmp_path):
    recs = [{"task_id": i, "gt": "A", "pred": "A", "cot_text": "t"} for i in range(5)]
    for first, second in (("a", "b"), ("b", "a")):
        folder = tmp_path / f"{first} first"
        folder.mkdir()
        (folder / f"{first}.json").write_text("\n \n" + json.dumps(recs[:2], indent=1))
        assert read_cot(spark, str(folder)).count() == 2
        (folder / "none.json").write_text("\n")
        (folder / f"{second}.json").write_text("\n".join(json.dumps(r) for r in recs[2:]))
        with pytest.raises(ValueError, match="read them apart"):
            read_cot(spark, str(folder))
        with pytest.raises(ValueError, match="read them apart"):
            read_cot(spark, f"{folder}/*.json")
        assert read_cot(spark, str(folder / f"{second}.json")).count() == 3


def test_read_images_and_options(spark, tmp_path):
    root = tmp_path / "data"
    for task, opts in [(1, {"B": "two", "A": "one"}), (2, None)]:
        d = root / f"task_{task}"
        d.mkdir(parents=True)
        (d / "composite.png").write_bytes(pictures.png(b"x"))
        (d / "data.json").write_text(json.dumps({"options": opts} if opts else {"other": 1}))
    imgs = read_images(spark, str(root), "*.png")
    assert sorted(r.path for r in imgs.select("path").collect()) == ["task_1/composite.png", "task_2/composite.png"]
    assert "content" not in imgs.select("path", "length")._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    idx = {r.path: r.valid for r in image_index(imgs).collect()}
    assert idx == {"task_1/composite.png": True, "task_2/composite.png": True}
    opts = {r.task_id: r.options for r in read_task_options(spark, str(root)).collect()}
    assert opts[1] == {"A": "one", "B": "two"} and opts[2] == {}
    txt = {r.task_id: r.t for r in read_task_options(spark, str(root)).select("task_id", I.options_text(F.col("options")).alias("t")).collect()}
    assert txt == {1: "A: one\nB: two", 2: ""}


def test_write_shards_manifest_and_footers(spark, tmp_path):
    out = str(tmp_path / "shards")
    orders = C.orders(spark, SF_SMALL)
    manifest = SH.write_shards(orders, out, ["o_orderkey"], samples_per_file=100)
    m = sorted(manifest.collect(), key=lambda r: r.shard_id)
    assert sum(r.num_samples for r in m) == orders.count() == read_pairs(spark, out).count()
    dirs = sorted(d for d in os.listdir(out) if d.startswith("shard_id="))
    assert len(dirs) == len(m)
    for d in dirs:  # one file per shard
        assert len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".parquet")]) == 1
    back = read_pairs(spark, f"{out}/shard_id=3").agg(F.min("gi"), F.max("gi")).collect()[0]
    assert (back[0], back[1]) == (300, 399)
    files = parquet_files(spark, out)
    foot = parquet_footers(spark, files)
    assert foot.agg(F.sum("num_rows")).collect()[0][0] == orders.count()
    doc = K.row_group_info(foot).collect()
    assert len(doc) == len(files) and all(v.num_rows > 0 for v in doc)
    listed = dataset_footers(spark, out)
    assert sorted((r.num_rows, r.num_row_groups) for r in listed.collect()) == sorted(
        (r.num_rows, r.num_row_groups) for r in foot.collect())
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1][:80]


def test_dataset_info_and_layout_b_roundtrip(spark, tmp_path):
    b = C.layout_b_rows(spark, SF_SMALL)
    out = str(tmp_path / "train")
    K.write_pairs(b, out)
    back = read_pairs(spark, out)
    info = K.dataset_info(back, out).collect()[0]
    assert info.num_samples == b.count()
    assert info.columns == ["task_id", "answer", "question_interleave", "solution_interleave", "question_images", "solution_images"]
    assert back.schema["question_interleave"].dataType.elementType.fieldNames() == ["content", "index", "type"]


def test_registry_errors_and_mixture(spark, tmp_path):
    reg = Registry()
    with pytest.raises(ValueError):
        reg.get_dataset_info("nope")
    out = str(tmp_path / "ds")
    SH.write_shards(C.orders(spark, SF_SMALL), out, ["o_orderkey"], samples_per_file=500)
    reg.register("orders_type", "orders_ds", handler=lambda df: df, data_dir=out, num_files=3)
    with pytest.raises(ValueError):
        reg.get_dataset_info("orders_type", "missing")
    with pytest.raises(ValueError):
        reg.get_dataset_class("other")
    assert reg.get_dataset_class("orders_type") is not None
    assert lookup(reg.to_df(spark), "orders_type").count() == 1
    mix = load_mixture(spark, reg, {"orders_type": {"dataset_names": ["orders_ds"], "num_used_data": [2], "weight": 0.5}})
    assert mix.count() == 1000 and mix.select("weight").distinct().collect()[0][0] == 0.5


def test_layout_a_json_is_parseable(spark):
    a = C.layout_a_rows(spark, SF_SMALL).collect()
    for r in a:
        q = json.loads(r.question_interleave)
        assert all("type" in e for e in q)
        assert all(("index" in e) == (e["type"] == "image") for e in q)


def test_row_counts_and_profile(spark, tmp_path):
    out = str(tmp_path / "rc")
    SH.write_shards(C.orders(spark, SF_SMALL), out, ["o_orderkey"], samples_per_file=400)
    per_file = K.row_counts(read_pairs(spark, out)).collect()
    assert sorted(r.num_samples for r in per_file) == [300, 400, 400, 400]
    prof = {r.column: r for r in K.length_profile(C.layout_b_rows(spark, SF_SMALL).select(
        F.size("solution_interleave").alias("n_solution")), ["n_solution"]).collect()}
    r = prof["n_solution"]
    assert r.min <= r.p25 <= r.p50 <= r.p75 <= r.max and r.min <= r.avg <= r.max


def test_read_images_relative_and_uri_roots(spark, tmp_path, monkeypatch):
    nested = tmp_path / "data" / "x" / "data" / "task_1"
    nested.mkdir(parents=True)
    (nested / "a.png").write_bytes(b"\x89PNG")
    monkeypatch.chdir(tmp_path / "data" / "x")
    assert [r.path for r in read_images(spark, "data").select("path").collect()] == ["task_1/a.png"]
    uri = f"file://{tmp_path}/data/x/data"
    assert [r.path for r in read_images(spark, uri).select("path").collect()] == ["task_1/a.png"]


@pytest.mark.parametrize("store", ["local", "viewfs"])
def test_footers_of_tables_that_are_folders(spark, tmp_path, store):
    """A table may be one file or a folder of files, below a store that tasks open
    themselves or one that only Spark's readers reach."""
    folder = tmp_path / "some tables.parquet"
    for k, name in enumerate(C.TABLE_NAMES):
        rows = spark.range(10 + k).withColumn("x", F.repeat(F.lit("x"), 50))
        if k % 3 == 0:  # one file
            rows.toPandas().to_parquet(_made(folder) / f"{name}.parquet")
        else:
            rows.repartition(k % 3 + 2).write.option("parquet.block.row.count.limit", 4).parquet(str(folder / f"{name}.parquet"))
    root = str(folder)
    if store == "viewfs":
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        conf.set("fs.viewfs.mounttable.footers.link./in", f"file://{tmp_path}")
        root = "viewfs://footers/in/some tables.parquet"
    got = {r["table_name"]: r["num_rows"] for r in C.footer_info(spark, root).collect()}
    assert got == {name: 10 + k for k, name in enumerate(C.TABLE_NAMES)}
    files = dataset_footers(spark, f"{root}/nation.parquet").collect()
    assert sum(r.num_rows for r in files) == 11 and all(r.num_row_groups == -(-r.num_rows // 4) for r in files)


def _made(folder):
    folder.mkdir(exist_ok=True)
    return folder


def test_shards_of_plain_rows_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    """Tasks write plain rows themselves: same folders, columns, types and rows, nulls included."""
    rows = spark.range(1_003).selectExpr(
        "id", "cast(id % 7 as int) as i", "if(id % 5 = 0, null, concat('é', id)) as s", "id / 3 as d", "id % 2 = 0 as b",
        "date_add(date'2020-01-31', cast(id as int)) as day", "cast(id % 100 as tinyint) as t")
    SH.write_shards(rows, str(tmp_path / "tasks"), [F.col("id").desc()], 10)
    assert SH._plain(rows, f"file:{tmp_path}/x") and not SH._plain(rows, "viewfs://x/y")
    assert not SH._plain(rows.withColumn("image", F.lit(b"x")), f"file:{tmp_path}/x")
    monkeypatch.setattr(SH, "_plain", lambda *_: False)
    SH.write_shards(rows, str(tmp_path / "spark"), [F.col("id").desc()], 10)
    got, want = (read_pairs(spark, str(tmp_path / k)) for k in ("tasks", "spark"))
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    of = lambda k: sorted(d for d in os.listdir(tmp_path / k) if not d.startswith("."))
    assert of("tasks") == of("spark") and len(of("tasks")) == 102  # with _SUCCESS
    for shard in (0, 57, 100):
        names = [f for f in os.listdir(tmp_path / f"tasks/shard_id={shard}")]
        assert len(names) == 1 and names[0].endswith(".parquet")
        first = read_pairs(spark, str(tmp_path / f"tasks/shard_id={shard}")).collect()
        assert [r.gi for r in first] == list(range(shard * 10, min(1_003, shard * 10 + 10)))
    # a folder that exists is written over by Spark's writer, as before
    monkeypatch.undo()
    SH.write_shards(rows.limit(25), str(tmp_path / "tasks"), ["id"], 10)
    assert of("tasks") == ["_SUCCESS", "shard_id=0", "shard_id=1", "shard_id=2"]


def test_first_files_of_many_folders_are_not_listed_by_a_task_each(spark, tmp_path):
    """The first files come from the folders that hold them, in the order of whole paths."""
    from tessera.sources.registry import _natural, first_files

    out = str(tmp_path / "many")
    SH.write_shards(spark.range(3_000), out, ["id"], 10)
    os.makedirs(f"{out}/_temporary/0")
    files = sorted(spark.read.parquet(out).inputFiles(), key=_natural)
    plain = lambda uris: [u.split(":", 1)[1].replace("///", "/") for u in uris]
    for n in (0, 1, 2, 11, 300, 400):
        assert plain(first_files(spark, out, n)) == plain(files[:n])
    one = files[0].replace("file://", "")
    assert plain(first_files(spark, one, 1)) == [one]
    reg = Registry()
    reg.register("t", "d", data_dir=out)
    sc = spark.sparkContext
    sc.setJobGroup("first-files", "")
    try:
        mix = load_mixture(spark, reg, {"t": {"dataset_names": ["d"], "num_used_data": [12]}})
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("first-files") for s in tracker.getJobInfo(j).stageIds]
        tasks = sum(tracker.getStageInfo(s).numTasks for s in stages)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert tasks < 30
    assert sorted(r["id"] for r in mix.collect()) == list(range(120))
    assert "shard_id" in mix.columns
