"""Hot keys: a key holding a third of the rows is split over salts, with the
same result as a plain join."""

import pictures
from pyspark.sql import functions as F

from tessera.operators import skew


def _data(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)]
    left = spark.createDataFrame(rows, "rid long, path string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "path string, v long")
    return left, right


def test_hot_keys_found(spark):
    left, _ = _data(spark)
    hot = skew.hot_keys(left, "path", 500)
    assert hot.n == 1 and hot.salts() == {"hot": 3}


def test_salted_join_equals_plain_join(spark):
    left, right = _data(spark)
    for how in ["inner", "left", "left_semi", "left_anti"]:
        plain = sorted(map(tuple, left.join(right, "path", how).collect()))
        salted = sorted(map(tuple, skew.salted_join(left, right, "path", how, min_rows=100).collect()))
        assert plain == salted, how


def test_hot_key_is_spread_over_tasks(spark):
    left, right = _data(spark)
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = skew.salted_join(left, right, "path", "inner", min_rows=100)
        per_task = out.filter(F.col("path") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
        plain = left.join(right, "path").filter(F.col("path") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(plain) == 1  # unsalted: the whole hot key lands in one task
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 1000


def test_pipeline_with_a_shared_image(spark):
    """A third of the records point at the same image: the salted plan gives
    the same layout rows as the plain one."""
    from tessera.operators import ingest as I

    png = pictures.png(b"x")
    recs = []
    for i in range(300):
        first = "shared.png" if i % 3 == 0 else f"own_{i}.png"
        recs.append((i, "A", "A", f"<image>{first}</image> step {i} <image>s_{i % 7}.png</image> end"))
    records = spark.createDataFrame(recs, "task_id long, gt string, pred string, cot_text string")
    images = spark.createDataFrame(
        [("shared.png", png)] + [(f"own_{i}.png", png) for i in range(300)] + [(f"s_{k}.png", png) for k in range(7)],
        "path string, content binary")
    options = spark.createDataFrame([], "task_id long, options map<string,string>")
    hot = I.hot_image_paths(records, min_rows=20)
    assert hot.salts()["shared.png"] == 6
    for build in (lambda h: I.to_layout_a(records, images, "skip", h), lambda h: I.to_layout_b(records, images, options, h)):
        plain = sorted(map(lambda r: tuple(map(str, r)), build(skew.NONE).collect()))
        salted = sorted(map(lambda r: tuple(map(str, r)), build(hot).collect()))
        assert plain == salted and len(plain) == 300
