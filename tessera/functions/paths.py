"""Image paths as they are compared: one spelling for each file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sql_of

_PARTS = "filter(split({p}, '/', -1), _x -> _x <> '' AND _x <> '.')"
# a stack of the parts: '..' takes the last one away, unless there is none or it is '..' itself
_FOLD = ("aggregate({parts}, CAST(array() AS ARRAY<STRING>), (_s, _x) -> CASE "
         "WHEN _x <> '..' THEN concat(_s, array(_x)) "
         "WHEN size(_s) > 0 AND element_at(_s, -1) <> '..' THEN slice(_s, 1, size(_s) - 1) "
         "WHEN startswith({p}, '/') THEN _s ELSE concat(_s, array(_x)) END)")


def canonical_sql(p: str) -> str:
    """``a//b``, ``./a/b`` and ``x/../a/b`` all read as ``a/b`` (by spelling
    alone: links are not followed).  A leading ``/`` and leading ``..`` stay;
    what ends in ``/``, ``/.`` or ``/..`` names a folder and keeps one ``/`` at
    its end, so it is no file's path.  Null stays null."""
    fold = _FOLD.format(parts=_PARTS.format(p=p), p=p)
    whole = f"concat(IF(startswith({p}, '/'), '/', ''), array_join({fold}, '/'), IF({p} RLIKE '(^|/)[.]{{0,2}}$' AND {p} <> '', '/', ''))"
    # few paths need it: the others pass as they are
    return f"IF({p} RLIKE '(^|/)[.]{{0,2}}(/|$)', replace({whole}, '//', '/'), {p})"


def canonical_path(c: Column | str) -> Column:
    return F.expr(canonical_sql(sql_of(c)))
