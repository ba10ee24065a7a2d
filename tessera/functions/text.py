"""Text segmentation as Spark column expressions (no Python in the hot path).

A *segment* is ``struct<type string, content string>``: ``type`` is
``'text'`` or ``'image'`` and ``content`` the stripped text or image path.
An *entry* adds ``index``: for an image, its 0-based ordinal in its section.

The expressions are written as Spark SQL text and handed to ``F.expr``: one
JVM call per expression instead of hundreds of Column-API round trips, with the
same plan.  Arguments are SQL expressions (usually column names); functions
named ``*_sql`` return text for embedding in larger expressions.

Every lambda reads only its own element.  Per-row arrays (the split parts,
the tag payloads, running counts) enter as higher-order function arguments
(``arrays_zip`` / ``zip_with``), so each is computed once per row; an outer
array referenced inside a lambda body would be re-evaluated for every element
once the optimizer inlines its projection.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tag syntax and placeholder the source records use.
IMAGE_OPEN = "<image>"
IMAGE_CLOSE = "</image>"
RENDER_PLACEHOLDER = "[render_result]"

# Python's str.strip() removes every char with str.isspace(): Unicode White_Space
# plus the four separators U+001C..U+001F.  Java's (?U)\s covers the former.
# The trailing run is matched possessively and only from a run's first char,
# so long inner whitespace runs cost linear time.
STRIP_REGEX = r"(?U)^[\s\x1c-\x1f]++|(?<![\s\x1c-\x1f])[\s\x1c-\x1f]++\z"

IS_IMAGE = "_x.type = 'image'"


def sql_str(s: str) -> str:
    """A Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NOT_SQL = re.compile(r"lambdafunction|namedlambdavariable|(^|[\s(,])(=|<=>|<|>|<=|>=|!|&&|\|\||[-+*/%])\(")


def sql_of(c: Column | str) -> str:
    """SQL text of an argument: a string is taken as SQL; a Column that is a
    name, an ``F.expr`` expression or a plain function of names is rendered to
    SQL.  Operator trees built with the Column API do not render to SQL, so
    they are refused — pass a column name or ``F.expr`` text instead."""
    if isinstance(c, str):
        return c
    text = c._jc.toString()
    if _NOT_SQL.search(text):
        raise ValueError(f"pass a column name or SQL text, not a Column-API expression: {text[:80]}")
    return text


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {sql_str(STRIP_REGEX)}, '')"


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` semantics (SQL ``trim`` only removes spaces)."""
    return F.expr(strip_sql(sql_of(c)))


def tag_patterns(dotall: bool) -> tuple[str, str]:
    """(split pattern, extract pattern) for image tags.

    dotall: a tag may span line breaks.  Strict: ``.`` stops at ``\\n`` only;
    ``(?d)`` (UNIX_LINES) is needed because Java's ``.`` also stops at ``\\r``.
    """
    flag = "(?s)" if dotall else "(?d)"
    return f"{flag}<image>.*?</image>", f"{flag}<image>(.*?)</image>"


def _prefix_end_sql(text: str) -> str:
    """End (1-based, inclusive) of the last ``</image>`` in ``text``, 0 if none.
    No tag can end after it, so the tag regexes only scan ``text`` up to here:
    without the cut, every unclosed ``<image>`` after the last closer would
    scan to the end of the text (quadratic on junk)."""
    q = f"locate({sql_str(IMAGE_CLOSE[::-1])}, reverse({text}))"
    return f"IF({q} > 0, length({text}) - {q} + 1, 0)"


def _prefix_sql(text: str) -> str:
    return f"substring({text}, 1, {_prefix_end_sql(text)})"


def image_paths_sql(text: str, dotall: bool = True) -> str:
    return f"regexp_extract_all({_prefix_sql(text)}, {sql_str(tag_patterns(dotall)[1])}, 1)"


def image_paths(text: Column | str, dotall: bool = True) -> Column:
    """All tag payloads in order, unstripped (T6 building block)."""
    return F.expr(image_paths_sql(sql_of(text), dotall))


def ordinals_sql(arr: str, pred: str) -> str:
    """``array<int>``: the 0-based ordinal of each element among those that
    satisfy ``pred`` (a condition on the lambda variable ``_x``), null for the
    others.  Chosen places are numbered by ``transform``'s position and put
    back in order by one sort, so a long array takes n log n steps."""
    placed = f"transform({arr}, (_x, _i) -> named_struct('i', _i, 'p', coalesce({pred}, false)))"
    chosen = f"transform(filter({placed}, _y -> _y.p), (_y, _k) -> named_struct('i', _y.i, 'k', _k))"
    others = f"transform(filter({placed}, _y -> NOT _y.p), _y -> named_struct('i', _y.i, 'k', CAST(NULL AS INT)))"
    return f"transform(sort_array(concat({chosen}, {others})), _z -> _z.k)"


def segments_sql(text: str, dotall: bool = True) -> str:
    split_pat, _ = tag_patterns(dotall)
    # split the tagged prefix, then glue the untagged tail onto its last part
    head = f"split({_prefix_sql(text)}, {sql_str(split_pat)}, -1)"
    tail = f"substring({text}, {_prefix_end_sql(text)} + 1)"
    parts = f"concat(slice({head}, 1, size({head}) - 1), array(concat(element_at({head}, -1), {tail})))"
    zipped = f"arrays_zip({parts}, {image_paths_sql(text, dotall)})"
    txt = f"named_struct('type', 'text', 'content', {strip_sql('_z.`0`')})"
    img = f"named_struct('type', 'image', 'content', {strip_sql('_z.`1`')})"
    keep = "_s.type = 'image' OR _s.content <> ''" if dotall else "_s.content <> ''"
    return (
        f"filter(flatten(transform({zipped}, _z -> IF(_z.`1` IS NULL, array({txt}), array({txt}, {img})))), "
        f"_s -> {keep})"
    )


def segments(text: Column | str, dotall: bool = True) -> Column:
    """T1 (dotall=True) / T2 (dotall=False): ordered text and image segments.

    ``split`` gives n+1 text parts and ``regexp_extract_all`` the n tag
    payloads; they are zipped (payload null after the last part) and
    flattened into text, image, text, … .  Blank text is dropped.  An empty
    image path is kept in dotall mode and dropped in strict mode.
    """
    return F.expr(segments_sql(sql_of(text), dotall))


def split_layout_a(segs: Column | str) -> tuple[Column, Column]:
    """question/solution split of strict segments.

    Closed form of the state machine: the question is the first segment, plus
    the second one when the first is text and the second an image.
    """
    s = sql_of(segs)
    k = (f"CASE WHEN size({s}) = 0 THEN 0 WHEN get({s}, 0).type = 'image' THEN 1 "
         f"WHEN get({s}, 1).type = 'image' THEN 2 ELSE 1 END")
    return F.expr(f"slice({s}, 1, {k})"), F.expr(f"slice({s}, {k} + 1, size({s}) - {k})")


def first_image_position_sql(segs: str) -> str:
    return f"array_position(transform({segs}, _s -> _s.type), 'image')"


def first_image_position(segs: Column | str) -> Column:
    """1-based position of the first image segment, 0 when there is none."""
    return F.expr(first_image_position_sql(sql_of(segs)))


def split_layout_b(segs: Column | str) -> tuple[Column, Column]:
    """T4: first image segment, and everything after it.

    Text before the first image is discarded.  Returns (first image segment,
    solution segments); both null when the text has no image.
    """
    s = sql_of(segs)
    f = first_image_position_sql(s)
    return (F.expr(f"IF({f} > 0, get({s}, {f} - 1), NULL)"),
            F.expr(f"IF({f} > 0, slice({s}, {f} + 1, size({s}) - {f}), NULL)"))


def entries_sql(segs: str, keep_path: bool = True) -> str:
    content = "_s.content" if keep_path else "IF(_s.type = 'image', CAST(NULL AS STRING), _s.content)"
    return (
        f"zip_with({segs}, {ordinals_sql(segs, IS_IMAGE)}, (_s, _c) -> named_struct("
        f"'type', _s.type, 'content', {content}, "
        f"'index', IF(_s.type = 'image', CAST(_c AS BIGINT), CAST(NULL AS BIGINT))))"
    )


def entries(segs: Column | str, keep_path: bool = True) -> Column:
    """T5: segments of one section → entries ``struct<type, content, index>``.

    ``index`` is the image's 0-based ordinal within the section (null for
    text).  With ``keep_path=False`` image entries carry no content (the
    stored shape of layout B).
    """
    return F.expr(entries_sql(sql_of(segs), keep_path))


def running_image_index_sql(arr: str) -> str:
    return (f"zip_with({arr}, {ordinals_sql(arr, IS_IMAGE)}, "
            f"(_e, _c) -> IF(_e.type = 'image', CAST(_c AS BIGINT), CAST(NULL AS BIGINT)))")


def running_image_index(arr: Column | str) -> Column:
    """T5 / W2 for any stored entry list: per entry, the number of image
    entries before it (null for non-image entries)."""
    return F.expr(running_image_index_sql(sql_of(arr)))


def count_images(arr: Column | str) -> Column:
    return F.expr(f"size(filter({sql_of(arr)}, _e -> _e.type = 'image'))")
