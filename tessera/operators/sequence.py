"""Stored rows → labelled training sequences.

All of it is per-row array work in built-in higher-order functions: no
shuffle, no Python.  A rejected row yields no sequence and a reason, so
every row is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.images import problem_sql, signature_sql
from ..functions.text import IS_IMAGE, ordinals_sql, sql_of, strip_sql
from .ingest import task_key

# The special tokens that close a solution text entry.
VISION_START = "<|vision_start|>"
IM_START = "<|im_start|>"
END_OF_TEXT = "<|endoftext|>"

REASON_OK = "ok"
REASON_BAD_JSON = "bad_json"
REASON_UNTRAINABLE = "untrainable"
REASON_NO_TYPE = "entry_without_type"
REASON_OUT_OF_BOUNDS = "index_out_of_bounds"
REASON_UNDECODABLE = "undecodable_image"


# ---------------------------------------------------------------- N1 / U1
def parse_interleave(c: Column | str) -> Column:
    """JSON string → ``array<struct<type, content, index>>``.

    Strict: the text must be one JSON array and nothing else (it is parsed as
    the first of two elements, so text after its end shows), ``content`` a
    string or null, and ``index`` an integer or null; otherwise the result is null.
    """
    root = f"try_variant_get(try_parse_json(concat('[', {sql_of(c)}, ', null]')), '$', 'array<variant>')"
    rows = "try_variant_get(get(_r, 0), '$', 'array<variant>')"
    kind = lambda f: f"coalesce(schema_of_variant(try_variant_get(_v, '$.{f}', 'variant')), 'VOID')"
    wrong = f"exists(_l, _v -> {kind('content')} NOT IN ('STRING', 'VOID') OR {kind('index')} NOT IN ('BIGINT', 'VOID'))"
    entry = ("named_struct('type', try_variant_get(_v, '$.type', 'string'), 'content', try_variant_get(_v, '$.content', 'string'), "
             "'index', try_variant_get(_v, '$.index', 'bigint'))")
    # the parsed root and its rows are bound to a name each, so the text is parsed once
    checked = f"get(transform(array({rows}), _l -> IF({wrong}, NULL, transform(_l, _v -> {entry}))), 0)"
    return F.expr(f"get(transform(array({root}), _r -> IF(size(_r) = 2, {checked}, NULL)), 0)")


def unify_layout_a(df: DataFrame) -> DataFrame:
    """U1 for layout A rows: parse JSON; ``parse_ok`` is false when a non-null
    string does not parse."""
    parsed = df.select("*", parse_interleave("question_interleave").alias("_q"), parse_interleave("solution_interleave").alias("_s"))
    ok = (F.col("question_interleave").isNull() | F.col("_q").isNotNull()) & (F.col("solution_interleave").isNull() | F.col("_s").isNotNull())
    return parsed.select(
        F.lit("a").alias("layout"),
        F.col("id").alias("key"),
        "answer",
        F.col("_q").alias("question_interleave"),
        F.col("_s").alias("solution_interleave"),
        "question_images",
        "solution_images",
        ok.alias("parse_ok"),
    )


def unify_layout_b(df: DataFrame) -> DataFrame:
    """U1 for layout B rows: reorder entry fields, unwrap ``{bytes}``."""
    ent = lambda c: F.expr(
        f"transform({c}, _e -> named_struct('type', _e.type, 'content', _e.content, 'index', _e.index))")
    img = lambda c: F.expr(f"transform({c}, _b -> _b.bytes)")
    return df.select(
        F.lit("b").alias("layout"),
        task_key(F.col("task_id")).alias("key"),
        "answer",
        ent("question_interleave").alias("question_interleave"),
        ent("solution_interleave").alias("solution_interleave"),
        img("question_images").alias("question_images"),
        img("solution_images").alias("solution_images"),
        F.lit(True).alias("parse_ok"),
    )


def unify_layouts(a: DataFrame | None, b: DataFrame | None) -> DataFrame:
    parts = ([unify_layout_a(a)] if a is not None else []) + ([unify_layout_b(b)] if b is not None else [])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- N5 / F7–F10 / J5
def _python_index_sql(images: str, e: str) -> str:
    """A stored ``index`` read the way a Python list is indexed: a missing
    index means 0, and a negative one counts from the end."""
    idx = f"coalesce({e}.index, 0)"
    return f"IF({idx} < 0, {idx} + size({images}), {idx})"


def _image_at_sql(images: str, e: str) -> str:
    """Positional dereference ``images[index]`` (null when out of range)."""
    return f"get({images}, CAST({_python_index_sql(images, e)} AS INT))"


def _first_problem_sql(entries: str, images: str) -> str:
    """First failing entry: no ``type``, index out of range (F8), image that
    fails the check (F9).  Each element's index, image and signature are
    computed once (chained transforms) and then only read."""
    resolved = (f"transform(transform({entries}, _e -> named_struct('e', _e, 'i', {_python_index_sql(images, '_e')}, "
                f"'b', {_image_at_sql(images, '_e')})), "
                f"_r -> named_struct('e', _r.e, 'i', _r.i, 'sig', {signature_sql('_r.b')}))")
    problem = (f"CASE WHEN _r.e.type IS NULL THEN '{REASON_NO_TYPE}' "
               f"WHEN _r.e.type = 'image' AND (_r.i >= size({images}) OR _r.i < 0) THEN '{REASON_OUT_OF_BOUNDS}' "
               f"WHEN _r.e.type = 'image' AND ({problem_sql('_r.sig')}) IS NOT NULL THEN '{REASON_UNDECODABLE}' END")
    return f"get(filter(transform({resolved}, _r -> {problem}), _p -> _p IS NOT NULL), 0)"


def reject_reason() -> Column:
    """Why a unified row yields no sequence; ``ok`` otherwise.

    Order: JSON (N1) → trainable (F7) → first failing entry of the question,
    then of the solution: no ``type``, index out of bounds (F8), image that
    fails the check (F9).
    """
    qi = "coalesce(question_images, CAST(array() AS ARRAY<BINARY>))"
    si = "coalesce(solution_images, CAST(array() AS ARRAY<BINARY>))"
    trainable = ("coalesce(answer, '') <> '' AND coalesce(size(question_interleave), 0) > 0 "
                 "AND coalesce(size(solution_interleave), 0) > 0")
    return F.expr(
        f"coalesce(IF(NOT parse_ok, '{REASON_BAD_JSON}', NULL), IF(NOT ({trainable}), '{REASON_UNTRAINABLE}', NULL), "
        f"{_first_problem_sql('question_interleave', qi)}, {_first_problem_sql('solution_interleave', si)}, '{REASON_OK}')"
    )


def with_reject_reason(unified: DataFrame) -> DataFrame:
    return unified.withColumn("reason", reject_reason())


def reject_counts(unified: DataFrame) -> DataFrame:
    return with_reject_reason(unified).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- W1 / N2–N4
def special_token_sql(next_type: str, is_last: str) -> str:
    """W1 for a solution text entry, from the *unfiltered* list: the next entry
    is an image → vision_start; else the entry is last → endoftext; else
    im_start."""
    return (f"CASE WHEN {next_type} = 'image' THEN '{VISION_START}' WHEN {is_last} THEN '{END_OF_TEXT}' "
            f"ELSE '{IM_START}' END")


def _items_sql(entries: str, images: str, section: str) -> str:
    """Sequence items of one section.  Each element is zipped with its
    neighbour's type, a last-entry flag and its running image count, so the
    lambda never indexes the outer list."""
    is_q = section == "question"
    n = f"size({entries})"
    next_type = (f"concat(slice(transform({entries}, _e -> _e.type), 2, greatest({n} - 1, 0)), "
                 f"array(CAST(NULL AS STRING)))")
    is_last = f"concat(array_repeat(false, greatest({n} - 1, 0)), array(true))"
    zipped = f"arrays_zip({entries}, {next_type}, {is_last}, {ordinals_sql(entries, IS_IMAGE)})"
    # arrays_zip names a field after a bare column argument, else by position
    e = f"_z.`{entries if entries.isidentifier() else '0'}`"
    text = strip_sql(f"coalesce({e}.content, '')")
    label = "CAST(NULL AS STRING)" if is_q else f"IF({e}.type = 'text', {special_token_sql('_z.`1`', '_z.`2`')}, NULL)"
    item = (
        "named_struct("
        # blank text is skipped, after its neighbours' labels are known
        f"'_emit', {e} IS NOT NULL AND (({e}.type = 'text' AND {text} <> '') OR {e}.type = 'image'), "
        f"'section', '{section}', 'type', {e}.type, "
        f"'content', IF({e}.type = 'text', {text}, CAST(NULL AS STRING)), "
        f"'image_index', CAST(IF({e}.type = 'image', coalesce({e}.index, 0), NULL) AS BIGINT), "
        f"'image_ordinal', CAST(IF({e}.type = 'image', _z.`3`, NULL) AS BIGINT), "
        f"'image', IF({e}.type = 'image', {_image_at_sql(images, e)}, CAST(NULL AS BINARY)), "
        f"'need_loss', {'false' if is_q else 'true'}, "
        f"'need_vae', coalesce({e}.type = 'image', false), 'need_vit', coalesce({e}.type = 'image', false), "
        f"'enable_cfg', true, 'special_token', {label})"
    )
    return f"transform({zipped}, _z -> {item})"


def _sequences(unified: DataFrame) -> DataFrame:
    """Accepted rows with their items in order, one array a row (no shuffle)."""
    ok = with_reject_reason(unified).filter(F.col("reason") == REASON_OK)
    items = F.expr(
        f"filter(concat({_items_sql('question_interleave', 'question_images', 'question')}, "
        f"{_items_sql('solution_interleave', 'solution_images', 'solution')}), _i -> _i._emit)"
    )
    return ok.select("layout", "key", items.alias("items"))


ITEM_FIELDS = ["section", "type", "content", "image_index", "image_ordinal", "image", "need_loss", "need_vae", "need_vit",
               "enable_cfg", "special_token"]


def sequence_items(unified: DataFrame) -> DataFrame:
    """Accepted rows → ``key, pos, section, type, content, image_index,
    image_ordinal, image (bytes), need_loss, need_vae, need_vit, enable_cfg,
    special_token`` — question entries then solution entries, in order."""
    return (
        _sequences(unified).select("layout", "key", F.posexplode("items").alias("pos", "it"))
        .select("layout", "key", F.col("pos").cast("long").alias("pos"), "it.*")
        .drop("_emit")
    )


def sequence_plan(unified: DataFrame) -> DataFrame:
    """U4 row-to-sequence handler: one row for each accepted record with its
    ordered items; a record without visible text has an empty sequence."""
    fields = ", ".join(f"'{f}', _i.{f}" for f in ITEM_FIELDS)
    sequence = f"transform(items, (_i, _p) -> named_struct('pos', CAST(_p AS BIGINT), {fields}))"
    return _sequences(unified).select("layout", "key", F.expr(sequence).alias("sequence"))
