"""Differential fuzz: segmentation, layout splits, strip and labels against
small pure-Python oracles, on random tag soup with exotic whitespace."""

import pictures
import random

from pyspark.sql import functions as F

import pyoracle as O
from tessera.functions import text as T
from tessera.operators import sequence as S

ATOMS = ["<image>", "</image>", "a", "b.png", " ", "\n", "\r", "\t", "\x0b", "\x1c", "\x1f", "　", "\xa0",
         " ", "\x85", "x y", "<image>", "</image>", "", "é"]


def _texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ATOMS) for _ in range(rnd.randint(0, 16))) for _ in range(n)]


def test_segments_and_layouts(spark):
    texts = _texts(3000, 7)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    sd, ss = T.segments(F.col("t"), True), T.segments(F.col("t"), False)
    qa, sa = T.split_layout_a(ss)
    first, sb = T.split_layout_b(sd)
    rows = df.select("id", sd.alias("sd"), ss.alias("ss"), T.entries(qa).alias("qa"), T.entries(sa).alias("sa"),
                     first["content"].alias("fb"), T.entries(sb).alias("sb")).collect()
    bad = []
    for r in rows:
        t = texts[r.id]
        ent = lambda xs: [(e["type"], e["content"], e["index"]) for e in xs]
        got_b = None if r.fb is None else (r.fb, ent(r.sb))
        if ([(s.type, s.content) for s in r.sd] != O.segments_dotall(t)
                or [(s.type, s.content) for s in r.ss] != O.segments_strict(t)
                or (ent(r.qa), ent(r.sa)) != O.layout_a(t) or got_b != O.layout_b(t)):
            bad.append(t)
    assert not bad, bad[:3]


def test_strip_matches_python(spark):
    chars = [chr(c) for c in range(1, 0x3001)]
    texts = [c + "ab" + c for c in chars]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.s for r in df.select("id", T.py_strip(F.col("t")).alias("s")).collect()}
    diff = [hex(ord(chars[i])) for i, t in enumerate(texts) if got[i] != t.strip()]
    assert not diff, diff[:10]


def test_special_labels(spark):
    rnd = random.Random(3)
    lists = []
    for _ in range(400):
        lists.append([rnd.choice([("text", "t"), ("text", " "), ("image", None)]) for _ in range(rnd.randint(1, 6))])
    rows = [
        ("a", f"k{i}", "A", [("text", "q", None)],
         [(t, c, 0 if t == "image" else None) for t, c in ents], [], [pictures.png()],
         True)
        for i, ents in enumerate(lists)
    ]
    schema = ("layout string, key string, answer string, question_interleave array<struct<type:string,content:string,index:long>>, "
              "solution_interleave array<struct<type:string,content:string,index:long>>, question_images array<binary>, "
              "solution_images array<binary>, parse_ok boolean")
    df = spark.createDataFrame(rows, schema)
    items = S.sequence_items(df).filter(F.col("section") == "solution").filter(F.col("type") == "text")
    got = {}
    for r in items.orderBy("key", "pos").collect():
        got.setdefault(r.key, []).append(
            {S.VISION_START: "vision_start", S.END_OF_TEXT: "endoftext", S.IM_START: "im_start"}[r.special_token])
    for i, ents in enumerate(lists):
        assert got.get(f"k{i}", []) == O.special_labels(ents), ents


def test_strip_long_whitespace_runs(spark):
    texts = ["a" + " " * 20000 + "b" + "\n" * 5000, " " * 30000, "\t x \t"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.s for r in df.select("id", T.py_strip(F.col("t")).alias("s")).collect()}
    assert got == {i: t.strip() for i, t in enumerate(texts)}


def test_segments_property(spark):
    """Hypothesis-generated tag soup, checked in batches (one DataFrame per example)."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    piece = st.sampled_from(["<image>", "</image>", "<image></image>", "p.png", " ", "\n", "\r\n", "　",
                             "\x1d", "word", "<imag", "e>", "/", "é"])
    texts = st.lists(st.lists(piece, max_size=12).map("".join), min_size=50, max_size=150)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts)
    def check(batch):
        df = spark.createDataFrame(list(enumerate(batch)), "id long, t string")
        sd, ss = T.segments(F.col("t"), True), T.segments(F.col("t"), False)
        qa, sa = T.split_layout_a(ss)
        for r in df.select("id", sd.alias("sd"), T.entries(qa).alias("qa"), T.entries(sa).alias("sa")).collect():
            t = batch[r.id]
            assert [(s.type, s.content) for s in r.sd] == O.segments_dotall(t)
            ent = lambda xs: [(e["type"], e["content"], e["index"]) for e in xs]
            assert (ent(r.qa), ent(r.sa)) == O.layout_a(t)

    check()


def test_many_unclosed_tags_stay_linear(spark):
    """Junk with tens of thousands of unclosed tags: the scan stops at the last
    closer, so Spark stays fast (a regex oracle would itself be quadratic, so
    the expected segments are written out)."""
    import time

    t1 = "x</image>" + "<image>a " * 20000
    t2 = "<image>p</image>" + "<image>" * 30000 + "tail"
    df = spark.createDataFrame([(0, t1), (1, t2)], "id long, t string")
    t0 = time.perf_counter()
    rows = {r.id: r for r in df.select("id", T.segments(F.col("t"), True).alias("d"),
                                       T.segments(F.col("t"), False).alias("s")).collect()}
    assert time.perf_counter() - t0 < 30
    for mode in ("d", "s"):
        assert [(x.type, x.content) for x in rows[0][mode]] == [("text", t1.strip())]
        assert [(x.type, x.content) for x in rows[1][mode]] == [("image", "p"), ("text", "<image>" * 30000 + "tail")]
