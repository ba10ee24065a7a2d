"""Record ingest: filters, status waterfalls, layout A and layout B rows.

Records are ``task_id long, gt, pred, cot_text`` (see ``schemas.SOURCE``).
``task_id`` is taken as the record key, as in the reference (which never
checks that it is unique).

Status reports join the narrow image index (``path``, validity) and never
move bytes.  Layout rows join image bytes once, only for records that passed
the text checks, and take both the image status and the ordered byte lists
from one per-task group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.images import image_problem, problem_sql, signature_sql
from ..functions.paths import canonical_path
from ..sources.images import ImageFiles
from .images import join_files
from .skew import HotKeys, hot_key_rows, hot_keys, sample_share

# The question prompt of layout B, verbatim.
QUESTION_PROMPT = (
    "The top row of images shows different views of the initial state of a cube stack, while the bottom row "
    "shows different views of the final state after transformation. During the transformation process, blocks "
    "can move one unit in any direction (forward, backward, left, right, up, down). If the target position is "
    "empty, the block can move there directly; if the target position already has a block, they swap places. "
    "Blocks cannot float in the air. If a block is moved away from a position, any block above it will fall "
    "down until reaching a supporting surface. The xyz axes are shown in the diagram, and each block's position "
    "can be precisely identified using coordinates (x1,y1,z1). Which of the following transformation sequences "
    "can change the cube stack from the initial state to the final state shown in the diagram? Please answer "
    "from options A, B, C, or D."
)
OPTIONS_HEADER = "\n\nOptions:\n"

STATUS_OK = "ok"
STATUS_MISMATCH = "mismatch"
STATUS_RENDER = "render_result"
STATUS_OTHER = "other"
STATUS_NO_IMAGE = "no_image"
STATUS_IMAGE_ERROR = "image_error"

SECTIONS = ("question", "solution")
TEXT = "coalesce(cot_text, '')"


# ---------------------------------------------------------------- projections
def task_key(task_id: Column) -> Column:
    """``'task_' + task_id`` (``task_None`` for a missing id)."""
    return F.concat(F.lit("task_"), F.coalesce(task_id.cast("string"), F.lit("None")))


#: Key of a record: ids may be missing or repeated, what a record says may not.
RECORD = "_record"


def with_record_key(records: DataFrame) -> DataFrame:
    """Adds ``RECORD``, a hash of all columns.  Records that are equal in every
    column share it, and everything derived from them is equal too."""
    return records.withColumn(RECORD, F.md5(F.to_json(F.struct(*records.columns))))


def with_defaults(records: DataFrame) -> DataFrame:
    """Missing text fields read as ``''`` (JSON null and an absent key alike)."""
    return records.select(
        "task_id",
        task_key(F.col("task_id")).alias("id"),
        F.coalesce(F.col("gt"), F.lit("")).alias("gt"),
        F.coalesce(F.col("pred"), F.lit("")).alias("pred"),
        F.coalesce(F.col("cot_text"), F.lit("")).alias("cot_text"),
    )


# ---------------------------------------------------------------- predicates
def is_correct() -> Column:
    """``pred == gt`` with ``None == None`` equal."""
    return F.col("pred").eqNullSafe(F.col("gt"))


def has_placeholder(token: str = T.RENDER_PLACEHOLDER) -> Column:
    """F2 (negated): the text contains the literal token."""
    return F.coalesce(F.col("cot_text"), F.lit("")).contains(token)


def is_nonempty() -> Column:
    """the text is non-empty."""
    return F.coalesce(F.col("cot_text"), F.lit("")) != ""


def text_status_a() -> Column:
    """F11 up to the image check: first failing check wins; null = go on."""
    return (
        F.when(~is_correct(), F.lit(STATUS_MISMATCH))
        .when(has_placeholder(), F.lit(STATUS_RENDER))
        .when(~is_nonempty(), F.lit(STATUS_OTHER))
    )


# ---------------------------------------------------------------- parsing
def parse_layout_a(records: DataFrame) -> DataFrame:
    """T2 → T3 → T5: adds ``question_entries`` and ``solution_entries``
    (``array<struct<type, content, index>>``; images carry their path)."""
    segs = records.withColumn("_segs", T.segments(TEXT, dotall=False))
    q, s = T.split_layout_a("_segs")
    return (
        segs.withColumn("_q", q)
        .withColumn("_s", s)
        .withColumn("question_entries", T.entries("_q"))
        .withColumn("solution_entries", T.entries("_s"))
        .drop("_segs", "_q", "_s")
    )


def parse_layout_b(records: DataFrame) -> DataFrame:
    """T1 → T4 → T5: adds ``question_path`` (first image, null when none) and
    ``solution_entries`` (``type, content, index``; images carry their path)."""
    segs = records.withColumn("_segs", T.segments(TEXT, dotall=True))
    first, sol = T.split_layout_b("_segs")
    return (
        segs.withColumn("question_path", first["content"])
        .withColumn("_sol", sol)
        .withColumn("solution_entries", T.entries("_sol"))
        .drop("_segs", "_sol")
    )


def _image_items(entries: str, section: str) -> str:
    return (f"transform(filter({entries}, _e -> _e.type = 'image'), "
            f"_e -> named_struct('section', '{section}', 'pos', _e.index, 'path', _e.content))")


def image_refs_a(parsed: DataFrame) -> DataFrame:
    """T6 for layout A: ``task_id, section, pos, path`` (pos = index in section)."""
    return parsed.select(
        "task_id",
        F.inline(F.expr(f"concat({_image_items('question_entries', 'question')}, "
                        f"{_image_items('solution_entries', 'solution')})")),
    )


def _stripped_paths(dotall: bool) -> Column:
    paths = f"transform({T.image_paths_sql(TEXT, dotall)}, _p -> {T.strip_sql('_p')})"
    return F.expr(paths if dotall else f"filter({paths}, _p -> _p <> '')")


def kept_image_refs(records: DataFrame, dotall: bool, key: str = "task_id") -> DataFrame:
    """``key, ord, path``: every kept image of each record in text order,
    from the tag payloads alone (no segmentation of the text parts).

    dotall (layout B): every tag is an image, empty paths included; ord 0 is the
    question image, ord k the solution image with index k-1.  Strict
    (layout A): blank paths are dropped; only ord 0 can be in the question.
    """
    return records.select(key, F.posexplode(_stripped_paths(dotall)).alias("ord", "path")).withColumn(
        "ord", F.col("ord").cast("long")
    )


# ---------------------------------------------------------------- status
def hot_image_paths(records: DataFrame, min_rows: int | None = None, images: DataFrame | None = None, min_bytes: int | None = None) -> HotKeys:
    """Image files referenced by at least ``min_rows`` tags, counted once from
    the raw text (tag payloads, added up before the shuffle).  Shared by every
    path join of a pipeline, so the detection pass runs once, not once per join.
    With ``images`` (``path, content``), files also count by the bytes that their
    references will carry."""
    min_rows = min_rows if min_rows is not None else hot_key_rows(records)
    # sample records before the regex runs, so detection parses only the sample
    share = sample_share(min_rows) if images is None else 1.0
    src = records if share >= 1.0 else records.sample(fraction=share, seed=17)
    paths = src.select(F.explode(T.image_paths(TEXT, dotall=True)).alias("_p")).select(T.py_strip("_p").alias("_p")).select(canonical_path("_p").alias("_file"))
    sizes = images.select(canonical_path("path").alias("_file"), F.length("content").cast("long").alias("bytes")) if images is not None else None
    return hot_keys(paths, "_file", min_rows, sizes, min_bytes, share)


def status_a(records: DataFrame, index: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """F11 for layout A: ``mismatch`` → ``render_result`` → ``other`` → ``ok``.

    ``other`` also covers "no referenced image exists" (F4).  Adds
    ``question_entries``, ``solution_entries`` and ``status``.
    """
    records = with_record_key(records)
    parsed = parse_layout_a(records.withColumn("_pre", text_status_a()))
    refs = kept_image_refs(records.filter(text_status_a().isNull()), dotall=False, key=RECORD)
    found = (
        join_files(refs.select(RECORD, "path"), index.select("path"), "left_semi", hot)
        .select(RECORD)
        .distinct()
        .withColumn("_found", F.lit(True))
    )
    return (
        parsed.join(found, RECORD, "left")
        .withColumn(
            "status",
            F.coalesce(F.col("_pre"), F.when(F.col("_found"), F.lit(STATUS_OK)).otherwise(F.lit(STATUS_OTHER))),
        )
        .drop("_pre", "_found", RECORD)
    )


def status_b(records: DataFrame, index: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Layout B: ``no_image`` (F5) → ``image_error`` (F6: a referenced image is
    missing or fails the check) → ``ok``.  Adds parse columns and ``status``."""
    records = with_record_key(records)
    parsed = parse_layout_b(records)
    refs = kept_image_refs(records, dotall=True, key=RECORD)
    bad = (
        join_files(refs.select(RECORD, "path"), index.filter(F.col("valid")).select("path"), "left_anti", hot)
        .select(RECORD)
        .distinct()
        .withColumn("_bad", F.lit(True))
    )
    return (
        parsed.join(bad, RECORD, "left")
        .withColumn(
            "status",
            F.when(F.col("question_path").isNull(), F.lit(STATUS_NO_IMAGE))
            .when(F.col("_bad"), F.lit(STATUS_IMAGE_ERROR))
            .otherwise(F.lit(STATUS_OK)),
        )
        .drop("_bad", RECORD)
    )


def ingest_report(with_status: DataFrame) -> DataFrame:
    """A1 / A2: rows per status."""
    return with_status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- options
def options_text(options: Column | str) -> Column:
    """O1: options sorted by key, ``"k: v"`` joined by newlines (a null
    value prints as ``None``); null map → ``''``."""
    m = T.sql_of(options)
    return F.expr(f"coalesce(array_join(transform(array_sort(map_entries({m})), "
                  f"_e -> concat(_e.key, ': ', coalesce(_e.value, 'None'))), '\\n'), '')")


def question_prompt(opts_text: Column, prompt: str = QUESTION_PROMPT) -> Column:
    """The prompt, plus the options block when there are options."""
    return F.when(opts_text != "", F.concat(F.lit(prompt), F.lit(OPTIONS_HEADER), opts_text)).otherwise(F.lit(prompt))


def join_options(records: DataFrame, option_maps: DataFrame) -> DataFrame:
    """``options_text`` by ``task_id``; a task without options gets ``''``."""
    return records.join(option_maps.select("task_id", "options"), "task_id", "left").withColumn(
        "options_text", options_text(F.col("options"))
    ).drop("options")


# ---------------------------------------------------------------- missing images
def missing_policy(df: DataFrame, mode: str) -> DataFrame:
    """J4 on entries, given ``_miss_question`` / ``_miss_solution`` (sorted
    positions of image entries whose file is missing)."""
    if mode == "skip":
        return df
    miss = {s: f"coalesce(_miss_{s}, CAST(array() AS ARRAY<BIGINT>))" for s in SECTIONS}
    if mode == "drop_row":
        return df.filter(F.expr(f"size({miss['question']}) + size({miss['solution']}) = 0"))
    if mode != "compact":
        raise ValueError(f"unknown on_missing mode {mode!r}")
    out = df
    for s in SECTIONS:
        col = f"{s}_entries"
        out = out.withColumn(col, _compact(col, miss[s]))
    return out


def _compact(entries: str, missing: str) -> Column:
    """Entries without the missing images, image indexes renumbered 0..k-1.

    Places of image entries and missing indexes are merged by one sort: an image
    whose index is among the missing ones stands right after it there, so a long
    list takes n log n steps."""
    images = f"transform({entries}, (_e, _i) -> named_struct('x', IF(_e.type = 'image', _e.index, NULL), 'i', _i))"
    gone = f"transform({missing}, _m -> named_struct('x', _m, 'i', -1))"
    merged = f"sort_array(concat({images}, {gone}))"
    # one pass over neighbours: the last missing index met is that of the entry, or not
    places = (f"transform(filter(zip_with({merged}, slice(concat(array(named_struct('x', CAST(NULL AS BIGINT), 'i', 0)), {merged}), 1, size({merged})), "
              "(_a, _b) -> named_struct('i', _a.i, 'gone', coalesce(_a.x = _b.x AND (_b.i = -1 OR _a.i = -1), false))), _y -> _y.i >= 0), _y -> _y)")
    flagged = f"zip_with({entries}, sort_array({places}), (_e, _g) -> named_struct('e', _e, 'gone', _g.gone))"
    kept = f"transform(filter({flagged}, _y -> NOT _y.gone), _y -> named_struct('type', _y.e.type, 'content', _y.e.content))"
    return F.expr(T.entries_sql(kept))


def missing_variants(df: DataFrame, modes: tuple[str, ...] = ("skip", "drop_row", "compact")) -> DataFrame:
    """J4 under several policies in one pass: adds ``mode``, one row for each policy
    that keeps the record, with that policy's entries."""
    none = "coalesce(size(_miss_question), 0) + coalesce(size(_miss_solution), 0) = 0"
    compacted = df.withColumns({f"_c_{s}": _compact(f"{s}_entries", f"coalesce(_miss_{s}, CAST(array() AS ARRAY<BIGINT>))") for s in SECTIONS})
    as_is = "question_entries, solution_entries"
    of_mode = {"skip": f"struct('skip' AS mode, {as_is})", "drop_row": f"IF({none}, struct('drop_row' AS mode, {as_is}), NULL)",
               "compact": "struct('compact' AS mode, _c_question AS question_entries, _c_solution AS solution_entries)"}
    rows = f"filter(array({', '.join(of_mode[m] for m in modes)}), _m -> _m IS NOT NULL)"
    rest = [c for c in df.columns if c not in ("question_entries", "solution_entries")]
    return compacted.select(*rest, F.explode(F.expr(rows)).alias("_m")).select(*rest, "_m.*")


def apply_missing_policy(parsed: DataFrame, refs_found: DataFrame, mode: str) -> DataFrame:
    """J4 on layout-A entries.

    ``refs_found`` is ``task_id, section, pos, found``.
    * ``skip``: keep every entry and index (bytes of missing files are simply
      absent from the image lists, so later indexes may dangle — as in the
      reference).
    * ``drop_row``: drop a record with any missing image.
    * ``compact``: remove entries of missing images and renumber the rest
      densely.
    """
    if mode == "skip":
        return parsed
    missing = refs_found.filter(~F.col("found")).groupBy("task_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("section") == s, F.col("pos")))).alias(f"_miss_{s}") for s in SECTIONS]
    )
    return missing_policy(parsed.join(missing, "task_id", "left"), mode).drop(*[f"_miss_{s}" for s in SECTIONS])


# ---------------------------------------------------------------- layouts
def task_images(joined: DataFrame, key: str = RECORD) -> DataFrame:
    """One pass over ``key, ord, content`` (content null = missing file): per
    record all its images in text order with their bytes (A3 before the
    section split), and the found / bad counts the status rules need.
    Validity is checked on the bytes already in hand.  Equal records bring each
    image several times; one of each place stays."""
    present = F.col("content").isNotNull()
    bad = ~present | image_problem(F.col("content")).isNotNull()
    return joined.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col("ord").alias("ord"), F.col("content").alias("b")))).alias("_imgs"),
        F.count("content").alias("_n_found"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("_n_bad"),
    ).withColumn("_imgs", F.expr("filter(_imgs, (_x, _i) -> _i = 0 OR _imgs[_i - 1].ord <> _x.ord)"))


def _split_images(df: DataFrame, q_count: str) -> DataFrame:
    """Per-section byte lists and missing positions from ``_imgs`` (ordered by
    ``ord``), given (as SQL) how many of the first images belong to the
    question.  The count rides along as a zipped argument so the lambdas read
    only their element."""
    tagged = (f"zip_with(_imgs, array_repeat(CAST({q_count} AS BIGINT), size(_imgs)), (_x, _q) -> named_struct("
              f"'q', _x.ord < _q, 'idx', IF(_x.ord < _q, _x.ord, _x.ord - _q), 'b', _x.b))")
    out = df.withColumn("_tagged", F.expr(tagged))
    for name, side in (("question", "_y.q"), ("solution", "NOT _y.q")):
        out = out.withColumn(
            f"{name}_images", F.expr(f"transform(filter(_tagged, _y -> {side} AND _y.b IS NOT NULL), _y -> _y.b)")
        ).withColumn(
            f"_miss_{name}", F.expr(f"transform(filter(_tagged, _y -> {side} AND _y.b IS NULL), _y -> _y.idx)")
        )
    return out.drop("_tagged", "_imgs")


def layout_a_candidates(records: DataFrame, images: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """``ok`` layout-A records with parsed entries, per-section image bytes and
    the positions of missing images (``_miss_question`` / ``_miss_solution``),
    before any missing-image policy is applied."""
    if hot is None:
        hot = hot_image_paths(records, images=images)
    pending = with_record_key(records).filter(text_status_a().isNull())
    joined = join_files(kept_image_refs(pending, dotall=False, key=RECORD), images.select("path", "content"), "left", hot)
    facts = task_images(joined).filter(F.col("_n_found") > 0)
    cand = parse_layout_a(pending).join(facts, RECORD).drop(RECORD)
    return _split_images(cand, QUESTION_IMAGES_A)


QUESTION_IMAGES_A = "size(filter(question_entries, _e -> _e.type = 'image'))"


def with_files_a(records: DataFrame, files: ImageFiles) -> DataFrame:
    """Layout A from image files: every record with its ``status`` and, if
    pending, its images (``_found``), read where the record is (no shuffle of
    bytes)."""
    paths = F.when(text_status_a().isNull(), _stripped_paths(dotall=False))
    return status_of_found(files.attach(records.withColumn("_paths", paths), "_paths", "_found").drop("_paths"), "a")


def status_of_found(records: DataFrame, layout: str) -> DataFrame:
    """Adds ``status`` to records with ``_found``, the bytes of their images in
    text order (null for a missing file); a rejected record's bytes are let go."""
    if layout == "a":
        any_found = F.when(F.expr("exists(_found, _b -> _b IS NOT NULL)"), F.lit(STATUS_OK)).otherwise(F.lit(STATUS_OTHER))
        status = F.coalesce(text_status_a(), any_found)
    else:
        bad = f"exists(transform(_found, _b -> {signature_sql('_b')}), _g -> ({problem_sql('_g')}) IS NOT NULL)"
        status = F.when(F.coalesce(F.size("_found"), F.lit(0)) <= 0, F.lit(STATUS_NO_IMAGE)).when(F.expr(bad), F.lit(STATUS_IMAGE_ERROR)).otherwise(F.lit(STATUS_OK))
    return records.withColumn("status", status).withColumn("_found", F.when(F.col("status") == STATUS_OK, F.col("_found")))


def ok_layout_a(with_status: DataFrame, on_missing: str = "skip") -> DataFrame:
    """The ``ok`` rows of :func:`with_files_a` as layout A."""
    ok = parse_layout_a(with_status.filter(F.col("status") == STATUS_OK).withColumn("_imgs", F.expr(_ORDERED)))
    return finish_layout_a(_split_images(ok, QUESTION_IMAGES_A), on_missing)


_ORDERED = "transform(_found, (_b, _i) -> named_struct('ord', CAST(_i AS BIGINT), 'b', _b))"


def with_files_b(records: DataFrame, files: ImageFiles) -> DataFrame:
    """Layout B from image files: every record with its ``status`` and images."""
    return status_of_found(files.attach(records.withColumn("_paths", _stripped_paths(dotall=True)), "_paths", "_found").drop("_paths"), "b")


def ok_layout_b(with_status: DataFrame, option_maps: DataFrame) -> DataFrame:
    """The ``ok`` rows of :func:`with_files_b` as layout B."""
    ok = parse_layout_b(with_status.filter(F.col("status") == STATUS_OK).withColumn("_imgs", F.expr(_ORDERED)))
    return _finish_layout_b(_split_images(ok, "1"), option_maps)


def to_layout_a(records: DataFrame, images: DataFrame, on_missing: str = "skip", hot: HotKeys | None = None) -> DataFrame:
    """Records → layout A rows (P4), for ``ok`` records only.

    ``id, answer, question_interleave (JSON), solution_interleave (JSON),
    question_images array<binary>, solution_images array<binary>``.

    Plan: text checks are map-only; the kept image paths (tag payloads) join
    the image files once (salted on ``path``); one group by record gives
    the ordered bytes and the found count; one join brings them back to the
    parsed records, where they are split into sections.  A record is ``ok``
    when at least one referenced image exists (F4).
    """
    return finish_layout_a(layout_a_candidates(records, images, hot), on_missing)


def finish_layout_a(candidates: DataFrame, on_missing: str = "skip") -> DataFrame:
    """Apply the missing-image policy (J4) and project to layout A."""
    ok = missing_policy(candidates, on_missing)
    return ok.select(
        task_key(F.col("task_id")).alias("id"),
        F.col("gt").alias("answer"),
        F.to_json(F.col("question_entries")).alias("question_interleave"),
        F.to_json(F.col("solution_entries")).alias("solution_interleave"),
        "question_images",
        "solution_images",
    )


def _b_entry(content: Column, index: Column, typ: str) -> Column:
    return F.struct(content.cast("string").alias("content"), index.cast("long").alias("index"), F.lit(typ).alias("type"))


def to_layout_b(records: DataFrame, images: DataFrame, option_maps: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Records → layout B rows (P4), ``ok`` records only: at least one image,
    and every referenced image present and valid (F5, F6).

    ``task_id, answer, question_interleave, solution_interleave
    (array<struct<content, index, type>>), question_images, solution_images
    (array<struct<bytes binary>>)``.  Same one-join, one-group plan as layout A.
    """
    if hot is None:
        hot = hot_image_paths(records, images=images)
    records = with_record_key(records)
    joined = join_files(kept_image_refs(records, dotall=True, key=RECORD), images.select("path", "content"), "left", hot)
    facts = task_images(joined).filter(F.col("_n_bad") == 0)
    parsed = parse_layout_b(records).filter(F.col("question_path").isNotNull())
    return _finish_layout_b(_split_images(parsed.join(facts, RECORD), "1"), option_maps)


def _finish_layout_b(candidates: DataFrame, option_maps: DataFrame) -> DataFrame:
    ok = join_options(candidates, option_maps)
    to_bytes = lambda arr: F.expr(f"transform({arr}, _b -> named_struct('bytes', _b))")
    question = F.array(
        _b_entry(question_prompt(F.col("options_text")), F.lit(None), "text"),
        _b_entry(F.lit(None), F.lit(0), "image"),
    )
    solution = F.expr("transform(solution_entries, _e -> named_struct("
                      "'content', IF(_e.type = 'text', _e.content, CAST(NULL AS STRING)), 'index', _e.index, 'type', _e.type))")
    return ok.select(
        "task_id",
        F.col("gt").alias("answer"),
        question.alias("question_interleave"),
        solution.alias("solution_interleave"),
        to_bytes("question_images").alias("question_images"),
        to_bytes("solution_images").alias("solution_images"),
    )
