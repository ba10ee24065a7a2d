"""Personal data: patterns propose spans, checksums confirm them, and words
nearby adjust the score.

=========  ==============================================================
kind       proposal and confirmation
=========  ==============================================================
email      local part, ``@``, dotted domain
ip         four dotted numbers, each at most 255
card       14 to 19 digits with single spaces or hyphens, Luhn checksum
phone      ``+`` and 10 to 15 digits with spaces, dots, brackets, hyphens
iban       two letters, two check digits, 11 to 30 letters or digits, mod 97
national   ``ddd-dd-dddd`` with no part of zeros; needs a word nearby
=========  ==============================================================

Every proposal gets a score: the kind's base score, plus ``CONFIRMED`` if its
checksum holds, plus ``NEARBY`` if a word that speaks for the kind lies within
``CONTEXT_CHARS`` code points before it or after it.  Spans with a score of
``THRESHOLD`` or more count.  The first four kinds reach the threshold by
themselves once their own test holds; an iban needs its checksum; a national
number needs the context.  A span of the last two kinds that overlaps one of
the first four is dropped.

Texts are read whole, and every scan takes time in proportion to the text: a
run of characters is entered at its start only.  Offsets are code points, end
exclusive.  Null text: empty, no spans.  Other columns, ids and repeated rows
play no part: one output row for each input row.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import sizing

KINDS = ("email", "ip", "card", "phone", "iban", "national")
BASE_KINDS = KINDS[:4]
THRESHOLD = 1.0
BASE_SCORE = {"email": 1.0, "ip": 1.0, "card": 0.4, "phone": 1.0, "iban": 0.4, "national": 0.6}
CONFIRMED, NEARBY = 0.6, 0.4
CONTEXT_CHARS = 40
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank", "transfer"),
    "national": ("ssn", "social", "security", "national"),
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}+))")
_IN_WORD = re.compile(r"[A-Za-z0-9]")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CONTEXT = {k: re.compile(r"\b(?:" + "|".join(v) + r")\w*", re.IGNORECASE) for k, v in CONTEXT.items()}
_HAS_DIGITS = re.compile(r"[0-9][0-9().\x20-]*[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each country code the longest cut at a word's end whose checksum
    holds: other words may follow a number, and one that only looks like a
    number may come before it."""
    floor = 0
    for m in _IBAN.finditer(text):
        start, cut = m.start(), m.end(1)
        if start < floor:
            continue
        if _IN_WORD.match(text, cut):
            cut = text.rfind(" ", start, cut)
        while len(number := text[start:max(start, cut)].replace(" ", "")) >= 15:
            if mod97(number):
                yield start, cut
                floor = cut
                break
            cut = text.rfind(" ", start, cut)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards."""
    floor, at = 0, text.find("@")
    while at >= 0:
        end = at + 1
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        floor = end
        at = text.find("@", end)


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """``(kind, start, end, checksum or own test holds)``; what fails the test
    of a base kind or of an iban is not proposed."""
    for start, end in _emails(text):
        yield "email", start, end, False
    if not _HAS_DIGITS.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", *m.span(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                yield "phone", *m.span(), False
    for start, end in _ibans(text):
        yield "iban", start, end, True
    for m in _NATIONAL.finditer(text):
        if m[1] != "000" and m[2] != "00" and m[3] != "0000":
            yield "national", *m.span(), False


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by start, then kind as listed."""
    found: list[tuple[str, int, int, float]] = []
    for kind, start, end, confirmed in _proposals(text):
        score = BASE_SCORE[kind] + CONFIRMED * confirmed
        before, after = text[max(0, start - CONTEXT_CHARS):start], text[end:end + CONTEXT_CHARS]
        if _CONTEXT[kind].search(before) or _CONTEXT[kind].search(after):
            score += NEARBY
        if score >= THRESHOLD:
            found.append((kind, start, end, round(score, 3)))
    if any(k not in BASE_KINDS for k, *_ in found):
        base = sorted((s, e) for k, s, e, _ in found if k in BASE_KINDS)
        starts = [s for s, _ in base]
        reach = [0, *itertools.accumulate((e for _, e in base), max)]  # furthest end of the first so many
        found = [x for x in found if x[0] in BASE_KINDS or reach[bisect.bisect_left(starts, x[2])] <= x[1]]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SPAN = "array<struct<kind: string, start: long, end: long, score: double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _names(kinds, span: str = "x") -> str:
    return f"{span}.kind in ({', '.join(repr(k) for k in kinds)})"


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: one row for each row of ``docs``."""
    sizing.bound_arrow(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in find_spans(t or "")]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], ["doc_id", "spans"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(scan, f"doc_id long, spans {SPAN}")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets,
    such as ``[EMAIL]``, and ``n_chars`` (if there) set to the new length.
    Overlapping spans are replaced together, under the kind of the first.  A
    null text stays null."""
    sizing.bound_arrow(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([None if t is None else _masked(t) for t in columns[at].to_pylist()], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.mapInArrow(scan, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out


def _masked(text: str) -> str:
    out, at = [], 0
    for kind, start, end, _ in find_spans(text):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`detect`."""
    told = "concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2(array_join(transform(filter(spans, x -> {_names(BASE_KINDS)}), x -> {told}), ','), 256)").alias("base_sha256"),
        F.expr(f"array_join(transform(spans, x -> {told}), ',')").alias("spans"),
    )
