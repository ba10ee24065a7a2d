"""The small literal cases of FIXTURES.md, end to end through the operators."""

import pictures
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import ingest as I
from tessera.operators import sequence as S
from tessera.operators import tokens as TK


def _a(spark, text):
    df = spark.createDataFrame([(1, "A", "A", text)], "task_id long, gt string, pred string, cot_text string")
    r = I.parse_layout_a(df).collect()[0]
    q = [(e["type"], e["content"], e["index"]) for e in r.question_entries]
    s = [(e["type"], e["content"], e["index"]) for e in r.solution_entries]
    return q, s


def _b(spark, text):
    df = spark.createDataFrame([(1, "A", "A", text)], "task_id long, gt string, pred string, cot_text string")
    r = I.parse_layout_b(df).collect()[0]
    if r.question_path is None:
        return None
    return r.question_path, [(e["type"], e["content"], e["index"]) for e in r.solution_entries]


def test_image_first(spark):
    q, s = _a(spark, "<image>a.png</image> x <image>b.png</image> y")
    assert q == [("image", "a.png", 0)]
    assert s == [("text", "x", None), ("image", "b.png", 0), ("text", "y", None)]


def test_text_first(spark):
    q, s = _a(spark, "q <image>a.png</image> x")
    assert q == [("text", "q", None), ("image", "a.png", 0)]
    assert s == [("text", "x", None)]
    first, sol = _b(spark, "q <image>a.png</image> x")
    assert first == "a.png" and sol == [("text", "x", None)]


def test_no_image(spark):
    assert _b(spark, "only text") is None
    q, s = _a(spark, "only text")
    assert q == [("text", "only text", None)] and s == []


def test_empty_tag(spark):
    q, s = _a(spark, "a<image></image>b<image>c.png</image>")
    assert q == [("text", "a", None)]
    assert s == [("text", "b", None), ("image", "c.png", 0)]
    first, sol = _b(spark, "a<image></image>b<image>c.png</image>")
    assert first == ""  # loads nothing → the row drops in layout B
    assert sol == [("text", "b", None), ("image", "c.png", 0)]


def test_tag_over_line_break(spark, one_col):
    df = one_col(["<image>a\n.png</image>x"])
    r = df.select(T.segments(F.col("t"), False).alias("s"), T.segments(F.col("t"), True).alias("d")).collect()[0]
    assert [(x.type, x.content) for x in r.s] == [("text", "<image>a\n.png</image>x")]
    assert [(x.type, x.content) for x in r.d] == [("image", "a\n.png"), ("text", "x")]


def test_unmatched_tag(spark, one_col):
    r = one_col(["<image>a.png x"]).select(T.segments(F.col("t"), True).alias("d")).collect()[0]
    assert [(x.type, x.content) for x in r.d] == [("text", "<image>a.png x")]


def test_missing_step_image_modes(spark):
    recs = spark.createDataFrame([(1, "A", "A", "<image>a</image>x<image>gone</image>y<image>c</image>")],
                                 "task_id long, gt string, pred string, cot_text string")
    images = spark.createDataFrame([("a", b"\x89PNG"), ("c", b"\x89PNG")], "path string, content binary")
    from tessera.operators.images import image_index, image_lookup

    idx = image_index(images)
    ok = I.status_a(recs, idx)
    found = image_lookup(I.image_refs_a(ok), idx).select("task_id", "section", "pos", "found")

    def sol(mode):
        r = I.apply_missing_policy(ok, found, mode).collect()
        return [[(e["type"], e["content"], e["index"]) for e in x.solution_entries] for x in r]

    assert sol("skip") == [[("text", "x", None), ("image", "gone", 0), ("text", "y", None), ("image", "c", 1)]]
    assert sol("drop_row") == []
    assert sol("compact") == [[("text", "x", None), ("text", "y", None), ("image", "c", 0)]]
    rows = I.to_layout_a(recs, images, "skip").collect()
    assert len(rows) == 1 and len(rows[0].solution_images) == 1  # bytes of 'gone' are absent, index kept


def test_labels(spark):
    sol = [("text", "t1", None), ("image", None, 0), ("text", "t2", None), ("text", "t3", None)]
    df = spark.createDataFrame(
        [("a", "k", "A", [("text", "q", None)], sol, [], [b"\x89PNG\r\n\x1a\n0000000049454E44AE426082"], True)],
        "layout string, key string, answer string, question_interleave array<struct<type:string,content:string,index:long>>, "
        "solution_interleave array<struct<type:string,content:string,index:long>>, question_images array<binary>, "
        "solution_images array<binary>, parse_ok boolean",
    )
    png = pictures.png(b"x")
    df = df.withColumn("solution_images", F.array(F.lit(png)))
    items = S.sequence_items(df).orderBy("pos").collect()
    assert [(i.section, i.type, i.special_token) for i in items] == [
        ("question", "text", None),
        ("solution", "text", S.VISION_START),
        ("solution", "image", None),
        ("solution", "text", S.IM_START),
        ("solution", "text", S.END_OF_TEXT),
    ]
    assert [i.need_loss for i in items] == [False, True, True, True, True]


def test_shift_and_pad(spark):
    df = spark.createDataFrame([(1, [5, 6, 7]), (2, [9])], "task_id long, tokens array<int>")
    ids, labels = TK.next_token_pairs(F.col("tokens"))
    df = df.select("task_id", ids.alias("input_ids"), labels.alias("labels"))
    out = {r.task_id: r for r in TK.pad_batches(df, ["task_id"], 2).collect()}
    assert out[1].input_ids == [5, 6] and out[2].input_ids == [0, 0]
    assert out[1].labels == [6, 7] and out[2].labels == [-100, -100]
    assert out[1].attention_mask == [1.0, 1.0] and out[2].attention_mask == [0.0, 0.0]


def test_python_style_image_index(spark):
    """``images[index]``: missing index → 0, negative counts from the end,
    beyond either end → rejected."""
    png = pictures.png(b"x")
    schema = ("layout string, key string, answer string, question_interleave array<struct<type:string,content:string,index:long>>, "
              "solution_interleave array<struct<type:string,content:string,index:long>>, question_images array<binary>, "
              "solution_images array<binary>, parse_ok boolean")
    rows = []
    for key, idx in [("neg1", -1), ("neg2", -2), ("neg3", -3), ("none", None), ("two", 2)]:
        rows.append(("a", key, "A", [("image", None, 0)], [("text", "t", None), ("image", None, idx)], [png], [png, b"bad"], True))
    df = spark.createDataFrame(rows, schema)
    got = {r.key: r.reason for r in S.with_reject_reason(df).collect()}
    assert got == {"neg1": S.REASON_UNDECODABLE, "neg2": S.REASON_OK, "neg3": S.REASON_OUT_OF_BOUNDS,
                   "none": S.REASON_OK, "two": S.REASON_OUT_OF_BOUNDS}
