"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, then the reply, which alone is trainable.  A conversation that does
not end with an assistant turn gets one more example, without a trainable
span, so that no turn is lost.

Template of a turn: ``<turn ROLE>`` text ``</turn>`` and a newline, ROLE being
url-encoded.  Inside texts the control strings ``<turn`` and ``</turn`` get a
backslash after ``<`` (one more, if there are some already), which
:func:`unescape` takes out; all other text stays as it is.

Offsets and lengths are code points of the formatted text.  Turns are ordered
by ``turn``, then role and text, so ties and repeated rows (all kept) have one
defined order; a null turn comes first.  A null text or role is empty; rows
with a null ``conv_id`` form one conversation.  Other columns are ignored.

Examples repeat their context: output is quadratic in the turns of one
conversation, which is what the expansion asks for.  One conversation is one
group, as its last example holds all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_ESCAPE = r"regexp_replace({0}, '<(\\\\*/?turn)', '<\\\\$1')"
_UNESCAPE = r"regexp_replace({0}, '<\\\\(\\\\*/?turn)', '<$1')"


def escape(text: str) -> str:
    """SQL: ``text`` with its control strings marked."""
    return _ESCAPE.format(text)


def unescape(text: str) -> str:
    return _UNESCAPE.format(text)


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, formatted, loss_start, loss_length``: example
    numbers from 0; the trainable span is empty where there is no reply."""
    turns = conversations.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = "concat('<turn ', url_encode(t.role), '>')"
    shown = grouped.withColumn("shown", F.expr(
        f"transform(turns, t -> named_struct('head', {head}, 'body', {escape('t.text')}, 'reply', t.role = '{ASSISTANT}'))"))
    ends = shown.withColumn("ends", F.expr(
        "filter(sequence(1, size(shown)), i -> shown[i - 1].reply or i = size(shown))"))
    each = ends.select("conv_id", "shown", F.posexplode("ends").alias("example", "n"))
    last = F.expr("shown[n - 1]")
    each = each.select(
        "conv_id", "example", last.alias("last"),
        F.expr(r"array_join(transform(slice(shown, 1, n - 1), s -> concat(s.head, s.body, '</turn>\n')), '')").alias("context"))
    return each.select(
        "conv_id", F.col("example").cast("long").alias("example"),
        F.concat("context", "last.head", "last.body", F.lit("</turn>\n")).alias("formatted"),
        (F.length("context") + F.length("last.head")).cast("long").alias("loss_start"),
        F.when(F.col("last.reply"), F.length("last.body")).otherwise(0).cast("long").alias("loss_length"),
        F.col("last.reply").alias("has_reply"),
    )


def parse(formatted: str) -> str:
    """SQL: the turns of a formatted text, ``array<struct<role, text>>``."""
    cut = f"array_remove(split({formatted}, '</turn>\\n'), '')"
    text = unescape("substring(s, instr(s, '>') + 1)")
    return f"transform({cut}, s -> named_struct('role', url_decode(substring(s, 7, instr(s, '>') - 7)), 'text', {text}))"


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from the examples alone."""
    loss = unescape("substring(formatted, cast(loss_start as int) + 1, cast(loss_length as int))")
    told = formatted.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("has_reply"), F.struct("example", F.expr(loss).alias("text"))))).alias("losses"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    ).withColumn("turns", F.expr(parse("whole"))).withColumn("loss", F.expr("array_join(transform(losses, x -> x.text), '')"))
    return told.select(
        "conv_id", F.expr("cast(size(turns) as bigint)").alias("n_turns"),
        F.expr(r"sha2(array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), ''), 256)").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
