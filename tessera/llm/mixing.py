"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words.  All sources together share 100% of all words by weight; a
source's target stops at ``max_epochs`` times its own words, and what it cannot
take goes to the others by weight, until none is above (the fixed point of this
is ``min(cap, level * weight)`` for one common level).

* Tape: a source's documents, shuffled by a hash, lie end to end; the tape is
  cut into blocks of ``block`` words, the last one shorter.  A source reads its
  tape once for each epoch and ends in the block that reaches its target.
* Schedule: place ``i`` of the mix has the van der Corput point of ``i`` (its
  bits reversed); points fall through the cumulative block counts to sources.
  With at least twice as many points as blocks, every source gets its blocks,
  and any stretch of the mix holds each source in about its share.
* Places are ranked within their source; place ``r`` takes block ``r`` (modulo
  the blocks of an epoch), joined by rank.

Nothing is collected but three totals.  Cumulated sizes and ranks are
computed in parts (hash ranges of a source's tape, stretches of the schedule)
whose sums are added up in tables of one row a part, so a source of a third of
all rows is no single task.

Defined cases: null text has size 0 and is never taken; null source is a source
of its own, the last by order; equal ids and repeated rows lie on the tape one
after the other, each on its own; an empty table gives no rows; a source
without words has target 0.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import sizing
from tessera.session import ensure_checkpoint_dir

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Words of a block, where there are enough for LEAST_PLACES blocks.
BLOCK_WORDS, LEAST_PLACES = 1024, 1 << 16
#: Most rows of one part of a tape or of the schedule.
PART_ROWS = 100_000


#: SQL: the words of a text, as an array.
WORDS = r"array_remove(split(translate(coalesce({0}, ''), '\t\n\u000B\u000C\r', '     '), ' '), '')"


def size_of(text: str = "text") -> Column:
    """Number of words of a text."""
    return F.expr(f"cast(size({WORDS.format(text)}) as bigint)")


def _running(parts: DataFrame, by: list[str], order: str, amount: str, alias: str) -> DataFrame:
    """Adds the sum of ``amount`` over the earlier rows of the same group."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(alias, F.coalesce(F.sum(amount).over(before), F.lit(0).cast("long")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sid, source, weight, source_size, target`` for each source of
    ``source, size``; ``sid`` counts sources by code point, null last."""
    one = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("sid", F.row_number().over(one) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")))
    sources = sources.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    # sources reach their caps in the order of cap / weight
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything = Window.partitionBy()
    rest = sources.withColumns({
        "capped": F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(everything),
    }).withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    # the level holds from the first source on that it leaves below its cap
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(everything)
    target = F.least(F.col("cap"), level["level"] * F.col("weight"))
    return rest.select("sid", "source", "weight", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _reversed_bits(value: str, bits: int) -> Column:
    """Van der Corput index of a ``bits``-bit point, and back."""
    if not bits:
        return F.lit(0).cast("long")
    return F.expr(f"cast(conv(reverse(lpad(bin({value}), {bits}, '0')), 2, 10) as bigint)")


class Mix:
    """The parts of one mix: ``tape`` (documents), ``blocks`` (what of a
    document lies in which block) and ``schedule`` (places of the mix)."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block: int | None = None, seed: int = 0):
        spark = docs.sparkSession
        ensure_checkpoint_dir(spark)
        sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of().alias("size"))
        sizes = sizes.withColumn("row", F.monotonically_increasing_id()).checkpoint()
        self.sources = source_targets(sizes, weights, max_epochs).checkpoint()
        rows, words = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        self.block = block or max(1, min(BLOCK_WORDS, words // LEAST_PLACES))
        block_length = F.lit(self.block).cast("long")
        keyed = sizes.join(self.sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")

        # the tape: cumulated sizes in the order of a hash, by ranges of the hash
        part_rows = sizing.rows_per_part(spark, rows, PART_ROWS)
        part_bits = max(1, -(-rows // part_rows)).bit_length()
        tape = keyed.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "row")).withColumn("_part", F.shiftright("_order", 64 - part_bits))
        parts = _running(tape.groupBy("sid", "_part").agg(F.sum("size").alias("n")), ["sid"], "_part", "n", "before").drop("n")
        within = Window.partitionBy("sid", "_part").orderBy("_order", "row").rowsBetween(Window.unboundedPreceding, -1)
        self.tape = tape.withColumn("_at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(parts, ["sid", "_part"]).withColumn(
            "at", F.col("before") + F.col("_at")).drop("_order", "_part", "_at", "before")
        first, last = F.expr(f"at div {self.block}"), F.expr(f"(at + size - 1) div {self.block}")
        cut = self.tape.filter("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
        self.blocks = cut.withColumns({
            "from": F.greatest("at", F.col("block") * block_length), "until": F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_length),
        })

        # the schedule: whole epochs, then blocks up to the target, the last one cut
        words_taken = F.floor("target").cast("long")
        in_epoch = F.expr(f"(source_size + {self.block - 1}) div {self.block}")
        need = self.sources.filter("source_size > 0").withColumn("words", words_taken).withColumn("epoch_blocks", in_epoch).withColumn(
            "last_words", F.expr("words % source_size")).withColumn(
            "places", F.expr(f"(words div source_size) * epoch_blocks + (last_words + {self.block - 1}) div {self.block}")).filter("places > 0")
        by_sid = Window.orderBy("sid")  # one row a source
        need = need.withColumns({
            "upto": F.sum("places").over(by_sid), "all": F.sum("places").over(Window.partitionBy()),
        }).checkpoint()
        total = need.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
        bits = max(0, (2 * total - 1).bit_length()) if total else 0
        points = 1 << bits
        edge = lambda c: F.expr(f"cast(ceil(cast({c} as decimal(38, 0)) * {points} / all) as bigint)")
        runs = need.withColumns({"lo": edge("(upto - places)"), "hi": edge("upto")}).filter("hi > lo").select(
            "*", F.explode(F.expr(f"sequence(lo, hi - 1, {PART_ROWS}L)")).alias("begin"))
        runs = runs.repartition("sid", "begin")
        drawn = runs.select("sid", "places", "epoch_blocks", "source_size", "last_words", F.expr("words div source_size").alias("epochs"),
                            F.explode(F.expr(f"sequence(begin, least(begin + {PART_ROWS - 1}, hi - 1))")).alias("point"))
        drawn = drawn.withColumn("place", _reversed_bits("point", bits)).withColumn("_part", F.expr(f"place div {8 * part_rows}"))
        counts = _running(drawn.groupBy("sid", "_part").agg(F.count("*").alias("n")), ["sid"], "_part", "n", "before").drop("n")
        by_place = Window.partitionBy("sid", "_part").orderBy("place")
        ranked = drawn.withColumn("_at", F.row_number().over(by_place) - 1).join(counts, ["sid", "_part"]).withColumn("rank", F.col("before") + F.col("_at"))
        epoch = F.expr("rank div epoch_blocks")
        self.schedule = ranked.filter(F.col("rank") < F.col("places")).select(
            "sid", "place", "rank", epoch.alias("epoch"), (F.col("rank") % F.col("epoch_blocks")).alias("block"),
            F.when(epoch < F.col("epochs"), F.col("source_size")).otherwise(F.col("last_words")).alias("tape_end"))

    def taken(self) -> DataFrame:
        """``row, doc_id, source, size, sid, source_size, target, at, taken,
        first_place`` for each document: how many of the words of :meth:`placed` are
        its own, and the first of their places (null if none)."""
        # a block is read once an epoch, to its end or to the tape's end of that epoch
        reads = self.schedule.groupBy("sid", "block", "tape_end").agg(F.count("*").alias("reads"), F.min("place").alias("place"))
        got = F.greatest(F.least(F.col("until"), F.col("tape_end")) - F.col("from"), F.lit(0))
        by_row = self.blocks.join(reads, ["sid", "block"]).groupBy("row").agg(
            F.sum(got * F.col("reads")).alias("taken"), F.min(F.when(got > 0, F.col("place"))).alias("first_place"))
        return self.tape.join(by_row, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def placed(self) -> DataFrame:
        """``place, row, doc_id, source, from, until, at``: the mix in order of
        ``place``, then ``at`` (where on the tape): words ``from`` to ``until``
        (exclusive) of the document."""
        parts = self.blocks.select("sid", "block", "row", "doc_id", "source", F.col("at").alias("_start"), "from", "until")
        return self.schedule.select("sid", "block", "place", "tape_end").join(parts, ["sid", "block"]).filter(F.col("from") < F.col("tape_end")).select(
            "place", "row", "doc_id", "source", (F.col("from") - F.col("_start")).alias("from"),
            (F.least("until", "tape_end") - F.col("_start")).alias("until"), F.col("from").alias("at"))


def digest(taken: DataFrame) -> DataFrame:
    """The contract's columns of :meth:`Mix.taken`."""
    return taken.select("doc_id", "size", "source_size", "target", "taken", "first_place")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken whole,
    and once more cut to its first words, joined by one space, where the mix ends
    inside it (``n_chars``, if there, follows).  Rows that are not taken go."""
    keyed = docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row"))
    mix = Mix(docs, **options).taken().filter("taken > 0").select(F.col("row").alias("_row"), "taken", "size")
    copies = keyed.join(mix, "_row").withColumn("copy", F.explode(F.expr("sequence(1, cast((taken + size - 1) div size as int))")))
    cut = F.col("copy") * F.col("size") > F.col("taken")
    first_words = F.expr(f"array_join(slice({WORDS.format('_doc.text')}, 1, cast(taken % size as int)), ' ')")
    changed = F.col("_doc").withField("text", first_words)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(first_words).cast(docs.schema["n_chars"].dataType))
    return copies.select(F.when(cut, changed).otherwise(F.col("_doc")).alias("_doc")).select("_doc.*")
