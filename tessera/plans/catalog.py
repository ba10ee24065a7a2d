"""Registered queries: one per operator group of SURVEY §2.

Each query takes ``(spark, sf_dir)``, reads the driver's tables (through the
derived fixtures) and returns a flat DataFrame whose columns match the DuckDB
oracle in ``plans.oracle`` (binary as md5, lists as joined strings).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ingest as I
from ..operators import order as O
from ..operators import sequence as S
from ..operators import tokens as TK
from ..operators.images import attach_bytes, collect_images, image_index, image_lookup, missing_images
from ..session import ensure_checkpoint_dir
from ..sinks import files as K
from ..sinks import shards as SH
from ..sources import fixtures as X
from ..sources.filesystems import qualified
from ..sources.footers import dataset_footers, parquet_footers
from ..sources.images import ImageFiles
from ..sources.records import read_cot, read_pairs, read_task_options
from ..sources.registry import Registry, load_mixture, lookup

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- shared inputs
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.cot_source(spark, sf_dir)


@X._per_session
def index_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_index(X.image_blobs(spark, sf_dir))


def _section_items(entries: str, section: str) -> str:
    return (f"transform({entries}, (_e, _i) -> named_struct('section', '{section}', 'pos', CAST(_i AS BIGINT), "
            f"'type', _e.type, 'content', _e.content, 'index', _e.index))")


def _explode_entries(df: DataFrame, *sections: str) -> DataFrame:
    parts = ", ".join(_section_items(f"{s}_entries", s) for s in sections)
    return df.select("task_id", F.inline(F.expr(f"concat({parts})")))


# ---------------------------------------------------------------- step 1: ingest status
@query("cot_normalised")
def cot_normalised(spark, sf_dir):
    """P1, P2."""
    return I.with_defaults(records(spark, sf_dir))


@query("ingest_status_a")
def ingest_status_a(spark, sf_dir):
    """Layout A status counts."""
    return I.ingest_report(I.status_a(records(spark, sf_dir), index_of(spark, sf_dir), hot_paths(spark, sf_dir)))


@query("ingest_status_b")
def ingest_status_b(spark, sf_dir):
    """Layout B status counts."""
    return I.ingest_report(I.status_b(records(spark, sf_dir), index_of(spark, sf_dir), hot_paths(spark, sf_dir)))


# ---------------------------------------------------------------- step 2: segmentation
def _segments(spark, sf_dir, dotall):
    segs = T.segments(F.coalesce(F.col("cot_text"), F.lit("")), dotall=dotall)
    return records(spark, sf_dir).select("task_id", F.posexplode(segs).alias("pos", "s")).select(
        "task_id", F.col("pos").cast("long").alias("pos"), F.col("s.type").alias("type"), F.col("s.content").alias("content")
    )


@query("segments_dotall")
def segments_dotall(spark, sf_dir):
    """T1, T7."""
    return _segments(spark, sf_dir, True)


@query("segments_strict")
def segments_strict(spark, sf_dir):
    """T2, T7."""
    return _segments(spark, sf_dir, False)


@query("layout_a_entries")
def layout_a_entries(spark, sf_dir):
    """question/solution entries with per-section image indexes."""
    return _explode_entries(I.parse_layout_a(records(spark, sf_dir)), "question", "solution")


@query("layout_b_entries")
def layout_b_entries(spark, sf_dir):
    """T4, T5: first image → question; everything after it → solution."""
    parsed = I.parse_layout_b(records(spark, sf_dir)).filter(F.col("question_path").isNotNull())
    q = F.array(F.struct(F.lit("image").alias("type"), F.col("question_path").alias("content"), F.lit(0).cast("long").alias("index")))
    return _explode_entries(parsed.withColumn("question_entries", q), "question", "solution")


@X._per_session
def refs_a(spark, sf_dir) -> DataFrame:
    return I.image_refs_a(I.parse_layout_a(records(spark, sf_dir)))


@query("image_refs")
def image_refs(spark, sf_dir):
    """Image paths per record, section and index."""
    return refs_a(spark, sf_dir)


# ---------------------------------------------------------------- step 3: joins and assembly
@query("image_lookup")
def image_lookup_q(spark, sf_dir):
    """Every reference with its file's length, md5 and validity (or not found)."""
    return image_lookup(refs_a(spark, sf_dir), index_of(spark, sf_dir), hot_paths(spark, sf_dir))


@query("missing_images")
def missing_images_q(spark, sf_dir):
    """References with no file."""
    return missing_images(refs_a(spark, sf_dir), X.image_blobs(spark, sf_dir), hot_paths(spark, sf_dir))


@query("options_text")
def options_text_q(spark, sf_dir):
    """S3 shape, O1: option map → sorted ``k: v`` lines."""
    return X.task_option_maps(spark, sf_dir).select("task_id", I.options_text(F.col("options")).alias("options_text"))


@query("question_prompt")
def question_prompt_q(spark, sf_dir):
    """Prompt plus options for every record."""
    joined = I.join_options(records(spark, sf_dir).select("task_id"), X.task_option_maps(spark, sf_dir))
    return joined.select("task_id", I.question_prompt(F.col("options_text")).alias("question_text"))


@query("images_collected")
def images_collected(spark, sf_dir):
    """A3: per record, md5 of each section's image bytes in order (missing skipped)."""
    got = collect_images(attach_bytes(refs_a(spark, sf_dir), X.image_blobs(spark, sf_dir), hot_paths(spark, sf_dir)))
    md5s = lambda c: F.expr(f"array_join(transform({c}, _b -> md5(_b)), ',')")
    return got.select(
        "task_id",
        F.size("question_images").cast("long").alias("n_question"),
        F.size("solution_images").cast("long").alias("n_solution"),
        md5s("question_images").alias("question_md5"),
        md5s("solution_images").alias("solution_md5"),
    )


@query("on_missing_modes")
def on_missing_modes(spark, sf_dir):
    """Image entries of ``ok`` layout-A records under skip / drop_row / compact."""
    # which files exist is all that matters here: the scan leaves their bytes out
    there = X.image_blobs(spark, sf_dir).select("path", F.lit(b"+").alias("content"))
    ok = I.layout_a_candidates(records(spark, sf_dir), there, hot_paths(spark, sf_dir))
    ents = I.missing_variants(ok.select("task_id", "question_entries", "solution_entries", "_miss_question", "_miss_solution"))
    parts = ", ".join(_section_items(f"{s}_entries", s) for s in ("question", "solution"))
    return ents.select("mode", "task_id", F.inline(F.expr(f"concat({parts})"))).filter(F.col("type") == "image").select(
        "mode", "task_id", "section", F.col("pos").alias("entry_pos"), "content", "index")


@query("image_validation")
def image_validation(spark, sf_dir):
    """U2 level 1: format, problem and validity per image file."""
    return index_of(spark, sf_dir)


# ---------------------------------------------------------------- step 4: ordering at scale

SPLIT_SEED = 42
SPLIT_RATIO = 0.9
SHUFFLE_EPOCH = 1
SAMPLES_PER_FILE = 100


def orders(spark, sf_dir) -> DataFrame:
    return X.table(spark, sf_dir, "orders")


@query("global_index")
def global_index_q(spark, sf_dir):
    """0-based position of every order in key order."""
    return O.global_index(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"]).select("o_orderkey", "gi")


@query("global_index_text")
def global_index_text(spark, sf_dir):
    """W3 on text keys, rows carrying a payload."""
    docs = X.table(spark, sf_dir, "documents").select("source", "text", "doc_id")
    return O.global_index(docs, ["source", F.col("doc_id").desc()]).select("doc_id", "source", F.length("text").cast("long").alias("chars"), "gi")


@query("shuffle_epoch")
def shuffle_epoch(spark, sf_dir):
    """O2: seeded permutation for one epoch."""
    out = O.shuffle(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", SPLIT_SEED, SHUFFLE_EPOCH)
    return out.select("o_orderkey", F.lit(SHUFFLE_EPOCH).cast("long").alias("epoch"), "gi")


@X._per_session
def _split(spark, sf_dir):
    return O.train_test_split(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", SPLIT_RATIO, SPLIT_SEED)


@query("train_test_split")
def train_test_split_q(spark, sf_dir):
    """90:10 split of the seeded permutation; index restarts per split."""
    return _split(spark, sf_dir).select("o_orderkey", "perm_idx", "split", "split_idx")


@query("split_counts")
def split_counts(spark, sf_dir):
    """A4: rows per split."""
    return _split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("num_samples"))


@query("split_integrity")
def split_integrity_q(spark, sf_dir):
    """Disjoint and complete."""
    return O.split_integrity(_split(spark, sf_dir), orders(spark, sf_dir), "o_orderkey")


@X._per_session
def _shards(spark, sf_dir):
    return SH.assign_shards(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], SAMPLES_PER_FILE)


@query("shard_manifest")
def shard_manifest_q(spark, sf_dir):
    """Consecutive 100-row shards and their index ranges."""
    return SH.shard_manifest(_shards(spark, sf_dir))


@query("shard_totals")
def shard_totals(spark, sf_dir):
    """K2 totals."""
    return SH.manifest_totals(SH.shard_manifest(_shards(spark, sf_dir)))


TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents embeddings "
               "pages benchmark labels conversations").split()


@query("footer_info")
def footer_info(spark, sf_dir):
    """Footer facts of the given parquet tables (read on executors), each
    a file or a folder of files."""
    base = qualified(spark, sf_dir)
    footers = parquet_footers(spark, [f"{base}/{t}.parquet" for t in TABLE_NAMES])
    name = F.expr(f"substring(path, {len(base) + 2})")
    return footers.groupBy(F.regexp_extract(name, r"^([^/]+)\.parquet(/|$)", 1).alias("table_name")).agg(F.sum("num_rows").alias("num_rows"))


# ---------------------------------------------------------------- written and read back
def _scratch(spark, name) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-roundtrip/{name}-{uuid.uuid4().hex}"


@query("records_roundtrip")
def records_roundtrip(spark, sf_dir):
    """Records written as JSON Lines and read with their schema."""
    folder = _scratch(spark, "records")
    records(spark, sf_dir).select("task_id", "gt", "pred", "cot_text").write.json(folder)
    return I.with_defaults(read_cot(spark, folder))


@query("pairs_roundtrip")
def pairs_roundtrip(spark, sf_dir):
    """Plain parquet of the shuffled orders."""
    folder = _scratch(spark, "pairs")
    K.write_pairs(O.shuffle(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", SPLIT_SEED, SHUFFLE_EPOCH), folder)
    return read_pairs(spark, folder).select("o_orderkey", F.lit(SHUFFLE_EPOCH).cast("long").alias("epoch"), "gi")


@query("shards_roundtrip")
def shards_roundtrip(spark, sf_dir):
    """Shards on disk, each row with its index and shard."""
    folder = _scratch(spark, "shards")
    SH.write_shards(orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), folder, ["o_orderkey"], 1_000)
    return read_pairs(spark, folder).select("o_orderkey", "gi", F.col("shard_id").cast("long").alias("shard_id"))


@query("shard_groups")
def shard_groups(spark, sf_dir):
    """K1, K2, K5: shards as row groups of a few files, their offset table, and
    what the files' footers say."""
    folder = _scratch(spark, "groups")
    table = SH.write_shard_groups(orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), folder, ["o_orderkey"], 1_000, num_files=4)
    footers = K.row_group_info(dataset_footers(spark, folder)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    groups = table.groupBy("path").agg(F.count(F.lit(1)).alias("shards"), F.sum("num_samples").alias("rows"))
    same = groups.join(footers, "path").withColumn("agree", (F.col("shards") == F.col("num_row_groups")) & (F.col("rows") == F.col("num_rows")))
    return table.join(same.select("path", "agree"), "path").select("shard_id", "num_samples", "start_idx", "end_idx", "agree")


@query("split_by_cut")
def split_by_cut(spark, sf_dir):
    """O3: the same split as ``train_test_split``, found by selection."""
    return O.exact_split(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", SPLIT_RATIO, SPLIT_SEED)


@query("array_roundtrip")
def array_roundtrip(spark, sf_dir):
    """Records written as JSON arrays, read by byte ranges."""
    folder = _scratch(spark, "arrays")
    rows = records(spark, sf_dir).select("task_id", "gt", "pred", "cot_text")
    X.write_files(rows.select(F.concat(F.lit("records-"), F.pmod("task_id", F.lit(3)), F.lit(".json")).alias("path"), F.to_json(F.struct("*")).alias("text")), folder, "[\n", ",\n", "\n]")
    return I.with_defaults(read_cot(spark, folder))


@query("images_by_path")
def images_by_path(spark, sf_dir):
    """The referenced files, and no others, opened by path."""
    folder = _scratch(spark, "images")
    X.write_files(X.image_blobs(spark, sf_dir).select("path", F.col("content").alias("text")), folder)
    files = ImageFiles(spark, folder)
    refs = refs_a(spark, sf_dir).select("path")
    read = files.read(refs).select("path", F.md5("content").alias("md5"))
    return files.facts(refs).join(read, "path", "left").select("path", "found", "length", "md5")


@query("options_files")
def options_files(spark, sf_dir):
    """S3: option files of tasks, read back."""
    folder = _scratch(spark, "options")
    maps = X.task_option_maps(spark, sf_dir)
    doc = F.to_json(F.struct("options", F.lit("other").alias("name")))
    X.write_files(maps.select(F.concat(F.lit("task_"), "task_id", F.lit("/data.json")).alias("path"), doc.alias("text")), folder)
    return read_task_options(spark, folder).select("task_id", I.options_text(F.col("options")).alias("options_text"))


@query("malformed_interleave")
def malformed_interleave(spark, sf_dir):
    """Stored rows whose JSON is no list, has text after it, or has fields
    of the wrong type, and their reasons."""
    rows = S.with_reject_reason(S.unify_layout_a(X.stored_rows(spark, sf_dir)))
    return rows.select("key", "reason", F.coalesce(F.size("question_interleave"), F.lit(-1)).cast("long").alias("n_question"))


# ---------------------------------------------------------------- step 5: training input

BATCH_SIZE = 4
TOKEN_BUDGET = 512


@X._per_session
def hot_paths(spark, sf_dir):
    """Hot image paths of the record view (one sampled detection pass)."""
    return I.hot_image_paths(records(spark, sf_dir))


@X._per_session
def a_candidates(spark, sf_dir) -> DataFrame:
    return I.layout_a_candidates(records(spark, sf_dir), X.image_blobs(spark, sf_dir), hot_paths(spark, sf_dir))


@X._per_session
def layout_a_rows(spark, sf_dir, on_missing: str = "skip") -> DataFrame:
    return I.finish_layout_a(a_candidates(spark, sf_dir), on_missing)


@X._per_session
def layout_b_rows(spark, sf_dir) -> DataFrame:
    return I.to_layout_b(records(spark, sf_dir), X.image_blobs(spark, sf_dir), X.task_option_maps(spark, sf_dir),
                         hot_paths(spark, sf_dir))


@X._per_session
def unified(spark, sf_dir) -> DataFrame:
    return S.unify_layouts(layout_a_rows(spark, sf_dir), layout_b_rows(spark, sf_dir))


@query("dataset_info")
def dataset_info_q(spark, sf_dir):
    """K4: info document of the layout-B dataset."""
    info = K.dataset_info(layout_b_rows(spark, sf_dir), "train.parquet")
    return info.select("num_samples", "file_path", F.array_join("columns", ",").alias("columns"))


@query("interleave_roundtrip")
def interleave_roundtrip(spark, sf_dir):
    """Layout-A JSON strings parse back to the entries they were written from."""
    u = S.unify_layout_a(layout_a_rows(spark, sf_dir))
    parts = ", ".join(_section_items(f"{s}_interleave", s) for s in ("question", "solution"))
    return u.select("key", F.inline(F.expr(f"concat({parts})")))


@query("unified_layouts")
def unified_layouts(spark, sf_dir):
    """Both layouts in one shape."""
    return unified(spark, sf_dir).select(
        "layout", "key", "answer",
        F.size("question_interleave").cast("long").alias("n_question"),
        F.size("solution_interleave").cast("long").alias("n_solution"),
        F.size("question_images").cast("long").alias("n_question_images"),
        F.size("solution_images").cast("long").alias("n_solution_images"),
    )


@query("reject_reasons")
def reject_reasons(spark, sf_dir):
    """Rows per layout and reason."""
    return S.with_reject_reason(unified(spark, sf_dir)).groupBy("layout", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("sequence_plan")
def sequence_plan_q(spark, sf_dir):
    """Labelled sequence items of every accepted row."""
    return S.sequence_items(unified(spark, sf_dir)).select(
        "layout", "key", "pos", "section", "type", "content", "image_index", "image_ordinal",
        F.md5("image").alias("image_md5"), "need_loss", "need_vae", "need_vit", "enable_cfg", "special_token",
    )


@X._per_session
def _text_rows(spark, sf_dir) -> DataFrame:
    b = layout_b_rows(spark, sf_dir)
    return b.select("task_id", TK.training_text(F.col("question_interleave"), F.col("solution_interleave")).alias("text"))


@query("sequence_rows")
def sequence_rows(spark, sf_dir):
    """U4: the row-to-sequence handler of the registered type, one row a record."""
    reg = Registry()
    reg.register(DATASET_TYPE, DATASET_NAME, handler=S.sequence_plan, data_dir="train", parquet_info_path="train/_manifest")
    rows = reg.get_dataset_class(DATASET_TYPE)(unified(spark, sf_dir))
    told = F.expr("array_join(transform(sequence, _i -> concat(_i.section, ':', _i.type, ':', coalesce(_i.special_token, ''))), ',')")
    return rows.select("layout", "key", F.size("sequence").cast("long").alias("n_items"), told.alias("items"))


@query("training_text")
def training_text_q(spark, sf_dir):
    """One training string per layout-B row."""
    return _text_rows(spark, sf_dir)


@X._per_session
def _token_rows(spark, sf_dir) -> DataFrame:
    t = _text_rows(spark, sf_dir).withColumn("tokens", TK.hash_tokenize(F.col("text")))
    ids, labels = TK.next_token_pairs(F.col("tokens"))
    return t.select("task_id", "tokens", ids.alias("input_ids"), labels.alias("labels"))


@query("token_pairs")
def token_pairs(spark, sf_dir):
    """Tokens (truncated to 4096) shifted into ids and labels."""
    return _token_rows(spark, sf_dir).select(
        "task_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join("input_ids", ",").alias("input_ids"),
        F.array_join("labels", ",").alias("labels"),
    )


@query("padded_batches")
def padded_batches(spark, sf_dir):
    """Batches of 4 in task order, padded to the batch maximum."""
    # tokens come from the whole layout-B pipeline: write them once before ordering
    out = TK.pad_batches(_token_rows(spark, sf_dir), ["task_id"], BATCH_SIZE, materialize=True)
    return out.select(
        "task_id", "batch_id", "row_in_batch", F.col("batch_max_len").cast("long").alias("batch_max_len"),
        F.array_join("input_ids", ",").alias("input_ids"),
        F.array_join("labels", ",").alias("labels"),
        F.expr("array_join(transform(attention_mask, _m -> CAST(_m AS INT)), ',')").alias("attention_mask"),
    )


@query("token_budget")
def token_budget(spark, sf_dir):
    """Rows over the token budget are flagged (and counted), not lost."""
    t = _token_rows(spark, sf_dir)
    return t.select("task_id", F.size("tokens").cast("long").alias("n_tokens"),
                    (F.size("tokens") <= TOKEN_BUDGET).alias("kept"))


# ---------------------------------------------------------------- step 6: registry and report


DATASET_TYPE = "interleaved_cot"
DATASET_NAME = "cot_train"


@query("registry_lookup")
def registry_lookup(spark, sf_dir):
    """Registry entry of the prepared dataset, with counts taken from the data."""
    n = layout_a_rows(spark, sf_dir).count()
    reg = Registry()
    reg.register(DATASET_TYPE, DATASET_NAME, handler=S.sequence_plan, data_dir="train", parquet_info_path="train/_manifest",
                 num_total_samples=n, num_files=-(-n // SAMPLES_PER_FILE))
    reg.register(DATASET_TYPE, "another", data_dir="elsewhere")
    assert reg.get_dataset_class(DATASET_TYPE) is S.sequence_plan  # U4: type → row-to-sequence handler
    return lookup(reg.to_df(spark), DATASET_TYPE, DATASET_NAME).select(
        "type", "name", "data_dir", "parquet_info_path", "num_total_samples", "num_files")


@query("mixture_files")
def mixture_files(spark, sf_dir):
    """The first two of a dataset's files, in the order of the numbers in their
    paths, and all of another's."""
    folder = _scratch(spark, "mixture")
    SH.write_shards(orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), folder, ["o_orderkey"], 100)
    reg = Registry()
    reg.register("tables", "firsts", data_dir=folder)
    reg.register("tables", "whole", data_dir=f"{sf_dir}/customer.parquet")
    mix = load_mixture(spark, reg, {"tables": {"dataset_names": ["firsts", "whole"], "num_used_data": [2, None], "weight": 2}})
    return mix.groupBy("dataset", "weight").agg(F.count(F.lit(1)).alias("num_rows"), F.min("gi").alias("first_gi"), F.max("gi").alias("last_gi"))


@query("mixture")
def mixture(spark, sf_dir):
    """A weighted mixture of two registered datasets (the first parquet
    file of each), rows tagged with dataset and weight; reported per dataset."""
    reg = Registry()
    reg.register("tables", "orders", data_dir=f"{sf_dir}/orders.parquet")
    reg.register("tables", "lineitem", data_dir=f"{sf_dir}/lineitem.parquet")
    config = {"tables": {"dataset_names": ["orders", "lineitem"], "num_used_data": [1, 1], "weight": 0.5}}
    mix = load_mixture(spark, reg, config)
    return mix.groupBy("dataset", "weight").agg(F.count(F.lit(1)).alias("num_rows"))


@query("preview")
def preview(spark, sf_dir):
    """The first layout-B row, summarised (a top-1 report)."""
    b = layout_b_rows(spark, sf_dir).orderBy("task_id").limit(1)
    show = F.expr("transform(question_interleave, _e -> IF(_e.type = 'text', concat(substring(_e.content, 1, 50), '...'), "
                  "concat('index=', CAST(_e.index AS STRING))))")
    return b.select(
        "task_id", "answer",
        F.size("question_interleave").cast("long").alias("n_question"),
        F.size("solution_interleave").cast("long").alias("n_solution"),
        F.size("question_images").cast("long").alias("n_question_images"),
        F.size("solution_images").cast("long").alias("n_solution_images"),
        F.array_join(show, " | ").alias("question_preview"),
    )


@X._per_session
def _lengths(spark, sf_dir) -> DataFrame:
    return layout_b_rows(spark, sf_dir).select(
        "task_id",
        F.size("question_interleave").cast("long").alias("n_question"),
        F.size("solution_interleave").cast("long").alias("n_solution"),
        F.size("question_images").cast("long").alias("n_question_images"),
        F.size("solution_images").cast("long").alias("n_solution_images"),
    )


@query("length_profile")
def length_profile(spark, sf_dir):
    """List lengths per row."""
    return _lengths(spark, sf_dir)


@query("length_summary")
def length_summary(spark, sf_dir):
    """A6 for the whole dataset (exact min / max / sum / count)."""
    return _lengths(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("n_solution").alias("min_solution"),
        F.max("n_solution").alias("max_solution"),
        F.sum("n_solution").alias("sum_solution"),
        F.sum("n_solution_images").alias("sum_solution_images"),
    )
