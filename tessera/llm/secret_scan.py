"""Secrets: fixed patterns, and sliding-window entropy over candidate strings.

========  ================================================================
kind      span
========  ================================================================
assign    a key word such as ``password`` or ``api_key``, ``:`` or ``=``,
          and a value of 6 characters or more
access    ``AKIA`` and capitals or digits, 20 characters or more
hex       24 or more lower-case hex digits
digits16  windows of high entropy in a run of hex digits of one case
alnum     the same in letters and digits
base64    the same in letters, digits and ``+/_=-``
========  ================================================================

A candidate is a maximal run of ``CANDIDATE`` characters.  The narrowest class
that holds all its characters says how wide the window is and how much Shannon
entropy (bits a character) a window needs.  The window moves by one character
a step: one count goes up, one goes down, and with them the sum of
``c * log2 c`` (in whole units of 2**-32 bits, so nothing drifts); a step costs
the same whatever the width.  Windows also need as many digits and letters as
their class says: prose has none of the former.  Windows that pass and touch or
overlap make one span.

Allow-list: a span found by entropy is dropped if its candidate is a UUID, is
one of ``ALLOWED_VALUES``, holds a run of ``SEQUENCE`` characters in alphabetic
or numeric order, has only words between its slashes, or stands right after a
word that names a public digest (``sha256:``, ``commit``, ``integrity`` ...).
Spans of the first three kinds always stay; entropy spans that overlap one of
them are dropped.

Every text is read whole in time proportional to its length.  Offsets are code
points, end exclusive.  Null text: empty, no spans.  Other columns, ids, ties
and repeated rows play no part: one output row for each input row; an empty
table gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import sizing


class Class(NamedTuple):
    """A character class: its alphabet, the window, the bits a character it
    needs, and the least digits and letters in a window."""

    kind: str
    alphabet: re.Pattern
    width: int
    bits: float
    digits: int
    letters: int


CLASSES = (
    Class("digits16", re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z"), 24, 3.0, 4, 2),
    Class("alnum", re.compile(r"[A-Za-z0-9]+\Z"), 20, 3.6, 2, 3),
    Class("base64", re.compile(r"[A-Za-z0-9+/_=-]+\Z"), 24, 3.9, 2, 5),
)
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")

_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""")
_KEY_WORDS = ("passw", "secret", "token", "key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")

_UUID = re.compile(r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z")
_WORDS = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]*|[0-9]{1,4})(?:[/_=+-](?:[A-Z]?[a-z]*|[A-Z]*|[0-9]{1,4}))*\Z")
_DIGEST_BEFORE = re.compile(r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|commit|integrity|checksum|digest|etag|revision)[\"']?[\x20:=\"'-]{1,4}\Z")
_DIGEST_PREFIX = re.compile(r"(?:sha(?:1|256|384|512)|md5)[-=]")
DIGEST_CHARS = 24
SEQUENCE = 10
#: Digests of the empty string.
ALLOWED_VALUES = frozenset({
    "d41d8cd98f00b204e9800998ecf8427e",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
})

_UNIT = 1 << 32


def _terms(width: int) -> list[int]:
    """``c * log2 c`` for counts up to ``width``, in whole units."""
    return [0, *(round(c * math.log2(c) * _UNIT) for c in range(1, width + 1))]


_TERMS = {c.width: _terms(c.width) for c in CLASSES}


def windows(run: str, kind: Class) -> Iterator[tuple[int, float]]:
    """``(start, entropy)`` of each window of ``run`` that passes."""
    width, term = kind.width, _TERMS[kind.width]
    most = math.floor(width * (math.log2(width) - kind.bits) * _UNIT)
    count: dict[str, int] = {}
    total = digits = letters = 0
    for i, c in enumerate(run):
        if i >= width:
            old = run[i - width]
            n = count[old]
            count[old] = n - 1
            total -= term[n] - term[n - 1]
            digits -= old.isdigit()
            letters -= old.isalpha()
        n = count.get(c, 0)
        count[c] = n + 1
        total += term[n + 1] - term[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= width - 1 and total <= most and digits >= kind.digits and letters >= kind.letters:
            yield i - width + 1, math.log2(width) - total / _UNIT / width


def _in_sequence(run: str) -> bool:
    """Whether ``SEQUENCE`` characters follow each other by code point."""
    length = 1
    for a, b in zip(run, run[1:]):
        length = length + 1 if ord(b) - ord(a) == 1 else 1
        if length >= SEQUENCE:
            return True
    return False


def allowed(text: str, start: int, end: int, values: frozenset[str] = ALLOWED_VALUES) -> bool:
    """Whether the candidate at ``[start, end)`` is known to be no secret."""
    run = text[start:end]
    return (run.lower() in values or _UUID.match(run) is not None or _WORDS.match(run) is not None or _DIGEST_PREFIX.match(run) is not None
            or _DIGEST_BEFORE.search(text[max(0, start - DIGEST_CHARS):start]) is not None or _in_sequence(run))


def _by_entropy(text: str, values: frozenset[str]) -> Iterator[tuple[str, int, int, float]]:
    for m in CANDIDATE.finditer(text):
        run, at = m.group(), m.start()
        kind = next(c for c in CLASSES if c.alphabet.match(run))
        found: list[list] = []
        for start, bits in windows(run, kind):
            if found and at + start <= found[-1][1]:
                found[-1][1] = at + start + kind.width
                found[-1][2] = max(found[-1][2], bits)
            else:
                found.append([at + start, at + start + kind.width, bits])
        if found and not allowed(text, at, m.end(), values):
            for start, end, bits in found:
                yield kind.kind, start, end, bits


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the first three kinds, by start, then kind."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(k in low for k in _KEY_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_spans(text: str, values: frozenset[str] = ALLOWED_VALUES) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, bits)`` by start, then kind as listed; ``bits`` is
    the highest entropy of a window, 0 for the first three kinds."""
    base = base_spans(text)
    found = [(*s, 0.0) for s in base]
    at, reach = 0, -1  # spans of both lists come by start, so one sweep finds overlaps
    for kind, start, end, bits in _by_entropy(text, values):
        while at < len(base) and base[at][1] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            found.append((kind, start, end, round(bits, 3)))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SPAN = "array<struct<kind: string, start: long, end: long, bits: double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))


def detect(docs: DataFrame, values: frozenset[str] = ALLOWED_VALUES) -> DataFrame:
    """``doc_id, spans``: one row for each row of ``docs``."""
    sizing.bound_arrow(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "bits"), x, strict=True)) for x in find_spans(t.as_py() or "", values)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], ["doc_id", "spans"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(scan, f"doc_id long, spans {SPAN}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`detect`."""
    told = "concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))"
    base = ", ".join(repr(k) for k in BASE_KINDS)
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2(array_join(transform(filter(spans, x -> x.kind in ({base})), x -> {told}), ','), 256)").alias("base_sha256"),
        F.expr(f"array_join(transform(spans, x -> {told}), ',')").alias("spans"),
    )
