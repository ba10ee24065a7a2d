"""Test inputs derived from the driver's tables.

The driver tables hold no ``<image>`` tags, images or task folders, so these
views give them the shapes the pipeline reads (see FIXTURES.md §2).  Every row
is computed by Spark from ``conversations`` / ``part``, so the work grows with
the tables.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .filesystems import opened, qualified


def _per_session(fn):
    """Build a view's plan once per (session, folder).  DataFrames are
    immutable plans, so reusing one re-executes it from the files each time;
    only the file listing, plan-time statistics (hot keys) and the Python-side
    plan construction are shared."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, *args):
        key = (id(spark), spark.sparkContext.applicationId, *args)
        if key not in cache:
            cache[key] = fn(spark, *args)
        return cache[key]

    return wrapper


@_per_session
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _letter(n: F.Column) -> F.Column:
    return F.chr(F.lit(65) + n)


@_per_session
def cot_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records ``task_id long, gt, pred, cot_text`` — one per conversation.

    Turn 0 gets a composite image in front, odd turns a step image after,
    some records a placeholder, some mismatching ``pred``, some empty text and
    some no tags at all.  Some spell their paths as ``./x``, ``a/../x`` or ``x//y``.
    """
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    cid, turn = F.col("conv_id"), F.col("turn")
    tagged = cid % 19 != 4
    folder = F.concat(F.when(cid % 23 == 6, F.lit("./")).when(cid % 23 == 8, F.lit("other/../")).otherwise(F.lit("")),
                      F.lit("task_"), cid, F.when(cid % 23 == 9, F.lit("//")).otherwise(F.lit("/")))
    piece = F.concat(
        F.when((turn == 0) & tagged, F.concat(F.lit("<image>"), folder, F.lit("composite.png</image>\n\n"))).otherwise(F.lit("")),
        F.col("text"),
        F.when((turn % 2 == 1) & tagged, F.concat(F.lit("\n<image>"), folder, F.lit("step_"), turn, F.lit(".png</image>\n"))).otherwise(F.lit("")),
        F.when((cid % 13 == 5) & (turn == 1), F.lit(" [render_result]")).otherwise(F.lit("")),
    )
    # A conversation is one record: its turns are bounded, so the per-key list is small.
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(turn.alias("t"), piece.alias("x")))), lambda r: r["x"]),
        "\n",
    )
    return (
        conv.groupBy("conv_id")
        .agg(joined.alias("_text"))
        .select(
            F.col("conv_id").alias("task_id"),
            _letter(cid % 4).alias("gt"),
            F.when(cid % 10 == 7, _letter((cid + 1) % 4)).otherwise(_letter(cid % 4)).alias("pred"),
            F.when(cid % 17 == 3, F.lit("")).otherwise(F.col("_text")).alias("cot_text"),
        )
    )


# Parts of a PNG of one gray pixel, as hex: signature and header, then pixel data
# and end.  A text chunk goes between them.
PNG_HEAD_HEX = "89504E470D0A1A0A" + "0000000D4948445200000001000000010800000000" + "3A7E9B55"
PNG_TAIL_HEX = "0000000A4944415478DA6360000000020001" + "E527DEFC" + "0000000049454E44" + "AE426082"
JPEG_HEAD_HEX = "FFD8FFE000047878" + "FFDA000801010000003F"
JPEG_TAIL_HEX = "FFD9"


def _little(n: str) -> str:
    """SQL: a number as four bytes, the lowest first."""
    return "unhex(concat(" + ", ".join(f"lpad(hex(({n} >> {k}) & 255), 2, '0')" for k in (0, 8, 16, 24)) + "))"


def _big(n: str) -> str:
    return f"unhex(lpad(hex({n}), 8, '0'))"


def picture_sql(kind: str, body: str) -> str:
    """SQL: an image file of a kind that carries the bytes ``body``."""
    chunk = f"concat(X'74455874', encode('Comment', 'UTF-8'), X'00', {body})"
    whole_png = f"concat(X'{PNG_HEAD_HEX}', {_big(f'length({chunk}) - 4')}, {chunk}, {_big(f'crc32({chunk})')}, X'{PNG_TAIL_HEX}')"
    bad_png = f"concat(X'{PNG_HEAD_HEX}', {_big(f'length({chunk}) - 4')}, {chunk}, {_big(f'crc32({chunk}) ^ 1')}, X'{PNG_TAIL_HEX}')"
    jpeg = f"concat(X'{JPEG_HEAD_HEX}', {body}, X'{JPEG_TAIL_HEX}')"
    padded = f"concat({body}, IF(length({body}) % 2 = 1, X'00', X''))"
    webp = f"concat(X'52494646', {_little(f'(length({padded}) + 12)')}, X'5745425056503820', {_little(f'length({body})')}, {padded})"
    # one row of so many gray pixels
    row = f"concat({body}, substring(X'000000', 1, pmod(-length({body}), 4)))"
    bmp = (f"concat(X'424D', {_little(f'(length({row}) + 54)')}, X'00000000', X'36000000', X'28000000', {_little(f'length({body})')}, X'01000000', "
           f"X'01000800', X'00000000', X'00000000', X'00000000', X'00000000', X'00000000', X'00000000', {row})")
    return {
        "text": body, "png": whole_png, "png_bad_crc": bad_png, "png_cut": f"substring({whole_png}, 1, length({whole_png}) - 12)",
        "png_more": f"concat({whole_png}, X'0000FFD93B')", "jpeg": jpeg, "jpeg_cut": f"substring({jpeg}, 1, length({jpeg}) - 2)",
        "webp": webp, "webp_cut": f"substring({webp}, 1, length({webp}) - 5)", "bmp": bmp, "bmp_cut": f"substring({bmp}, 1, length({bmp}) - 4)",
    }[kind]


#: Kind of an image by the remainder of its number; the others are whole PNG files.
KINDS = {3: "text", 7: "png_bad_crc", 11: "png_cut", 13: "png_more", 2: "jpeg", 8: "jpeg_cut", 17: "webp", 19: "webp_cut", 5: "bmp", 23: "bmp_cut"}


@_per_session
def image_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files ``path string, content binary``: whole, broken (cut, wrong
    checksum, no image), or absent; of several formats whatever their names say."""
    conv = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    path = F.concat(
        F.lit("task_"), cid, F.lit("/"),
        F.when(turn == 0, F.lit("composite")).otherwise(F.concat(F.lit("step_"), turn)),
        F.lit(".png"),
    )
    body = "encode(text, 'UTF-8')"
    kinds = " ".join(f"WHEN {k} THEN {picture_sql(kind, body)}" for k, kind in KINDS.items())
    content = F.expr(f"CASE (conv_id * 5 + turn) % 29 {kinds} ELSE {picture_sql('png', body)} END")
    return conv.filter(((turn == 0) | (turn % 2 == 1)) & ((cid * 7 + turn) % 23 != 0)).select(
        path.alias("path"), content.alias("content")
    )


def write_files(rows: DataFrame, folder: str, head: str = "", between: str = "", tail: str = "") -> None:
    """Writes ``path, text`` rows (text or bytes) as files below ``folder``, rows of
    one path into one file, by tasks."""
    base = qualified(rows.sparkSession, folder)

    def write(key, table):
        fs, where = opened(f"{base}/{key[0].as_py()}")
        fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
        parts = [t if isinstance(t, bytes) else t.encode() for t in table.column("text").to_pylist()]
        with fs.open_output_stream(where) as f:
            f.write(head.encode() + between.encode().join(parts) + tail.encode())
        return pa.table({"n": pa.array([len(parts)], pa.int64())})

    rows.groupBy("path").applyInArrow(write, "n long").agg(F.sum("n")).collect()


STORED = {0: "ok", 1: "bad_json", 2: "bad_json", 3: "bad_json", 4: "bad_json", 5: "bad_json", 6: "untrainable", 7: "entry_without_type", 8: "index_out_of_bounds", 9: "ok"}


@_per_session
def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout-A rows as they may come from elsewhere: their JSON is whole, cut,
    followed by text, no list, or has fields of other types."""
    conv = table(spark, sf_dir, "conversations").filter("turn = 0")
    said = "to_json(named_struct('type', 'text', 'content', text))"
    image = '{"type":"image","index":%s}'
    kinds = [
        f"concat('[', {said}, ',{image % 0}]')", f"concat('[', {said})", f"concat('[', {said}, '] and more')", said,
        f"concat('[', {said}, ',{image % '\"0\"'}]')", "concat('[{\"type\":\"text\",\"content\":', conv_id, '}]')", "'[]'",
        "to_json(array(named_struct('content', text)))", f"concat('[', {said}, ',{image % 3}]')", f"concat('[', {said}, ',{image % -1}]')",
    ]
    question = "CASE conv_id % 10 " + " ".join(f"WHEN {k} THEN {sql}" for k, sql in enumerate(kinds)) + " END"
    return conv.select(
        F.concat(F.lit("task_"), "conv_id").alias("id"), F.lit("A").alias("answer"), F.expr(question).alias("question_interleave"),
        F.lit('[{"type":"text","content":"end"}]').alias("solution_interleave"),
        F.array(F.expr(picture_sql("png", "encode(text, 'UTF-8')"))).alias("question_images"), F.expr("CAST(array() AS ARRAY<BINARY>)").alias("solution_images"))


@_per_session
def task_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per option ``task_id long, k string, v string``.

    Four options A–D per task (generated with ``explode``, not a cross join);
    the text is a part name looked up by an equi-join.
    """
    conv = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    opts = conv.filter(F.col("conv_id") % 11 != 0).select(
        F.col("conv_id").alias("task_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("o")
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_name"))
    return opts.join(part, ((F.col("task_id") * 4 + F.col("o")) % 200 + 1) == F.col("p_partkey")).select(
        "task_id", _letter(F.col("o")).alias("k"), F.col("p_name").alias("v")
    )


@_per_session
def task_option_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``task_id, options map<string,string>`` — the parsed ``data.json`` shape."""
    return task_options(spark, sf_dir).groupBy("task_id").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("options")
    )
