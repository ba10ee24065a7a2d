"""Token path of the trainer's input."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions.text import sql_of, sql_str
from .order import global_index

# Python's str.split() separators: Unicode white space and U+001C..U+001F.
WORD_SEPARATORS = r"(?U)[\s\x1c-\x1f]+"
DEFAULT_VOCAB = 65536
MAX_LENGTH = 4096
PAD_ID = 0
IGNORE_LABEL = -100


def training_text(question: Column | str, solution: Column | str) -> Column:
    """Text entries of the question then the solution, joined by one space."""
    q, a = sql_of(question), sql_of(solution)
    return F.expr(f"array_join(transform(filter(concat({q}, {a}), _e -> _e.type = 'text'), _e -> _e.content), ' ')")


def hash_tokenize(text: Column | str, vocab_size: int = DEFAULT_VOCAB, max_length: int | None = MAX_LENGTH) -> Column:
    """N7 default tokenizer: whitespace words, id = first 32 bits of md5 mod
    ``vocab_size``; truncated to ``max_length`` (O6).  Portable to any SQL
    engine with md5, so results can be checked outside Spark."""
    words = f"filter(split({sql_of(text)}, {sql_str(WORD_SEPARATORS)}), _w -> _w <> '')"
    ids = f"transform({words}, _w -> CAST(pmod(CAST(conv(substring(md5(_w), 1, 8), 16, 10) AS BIGINT), {int(vocab_size)}) AS INT))"
    return F.expr(f"slice({ids}, 1, {int(max_length)})" if max_length else ids)


def pandas_tokenizer(encode: Callable[[str], list[int]], max_length: int | None = MAX_LENGTH):
    """Wrap any ``str → list[int]`` encoder as an Arrow-batched UDF.

    Returns a function ``Column → Column`` producing ``array<int>``.
    """

    @F.pandas_udf(ArrayType(IntegerType()))
    def _encode(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            ids = [] if t is None else list(encode(t))
            out.append(ids[:max_length] if max_length else ids)
        return pd.Series(out)

    return _encode


@functools.lru_cache(maxsize=2)
def _loaded(path: str):
    """The tokenizer of a file, loaded once a worker."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def file_tokenizer(path: str, max_length: int | None = MAX_LENGTH, shipped: bool = False):
    """The tokenizer in a vocabulary file (``tokenizers`` JSON, or a
    ``sentencepiece`` model) as an Arrow-batched UDF, ``Column → array<int>``.

    Each worker loads it once and encodes whole batches.  ``path`` must be there on
    every executor; with ``shipped`` it is the name of a file that was sent along
    (``spark-submit --files`` or ``SparkContext.addFile``).  Null text has no ids.
    """

    @F.pandas_udf(ArrayType(IntegerType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from pyspark import SparkFiles

        encode = _loaded(SparkFiles.get(path) if shipped else path)
        for texts in batches:
            ids = encode([t or "" for t in texts])
            yield pd.Series([i[:max_length] if max_length else i for i in ids])

    return _encode


def next_token_pairs(tokens: Column) -> tuple[Column, Column]:
    """``input_ids = tokens[:-1]``, ``labels = tokens[1:]`` (empty-safe)."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.slice(tokens, 1, n), F.slice(tokens, 2, n)


def token_budget_filter(df: DataFrame, tokens: str = "tokens", max_tokens: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(rows within budget, over-long rows) — over-long rows are counted, not lost silently."""
    fits = F.size(F.col(tokens)) <= max_tokens
    return df.filter(fits), df.filter(~fits)


def pad_batches(df: DataFrame, order: list[str], batch_size: int, ids: str = "input_ids", labels: str = "labels",
                num_ranges: int | None = None, materialize: bool = False) -> DataFrame:
    """N9 + A5: consecutive batches of ``batch_size`` rows in ``order``; every
    row padded to its batch's longest sequence (ids with 0, labels with -100,
    mask 1.0/0.0).  The batch max is a window over one batch, so partitions
    hold at most ``batch_size`` rows per key — no skew by construction."""
    indexed = global_index(df, order, "gi", num_ranges=num_ranges, materialize=materialize)
    batched = indexed.withColumn("batch_id", F.floor(F.col("gi") / F.lit(batch_size)).cast("long")).withColumn(
        "row_in_batch", (F.col("gi") % F.lit(batch_size)).cast("long")
    )
    n = F.col("_len")
    pad = F.col("batch_max_len") - n
    return (
        batched.withColumn("_len", F.size(F.col(ids)))
        .withColumn("batch_max_len", F.max("_len").over(Window.partitionBy("batch_id")))
        .withColumn("input_ids", F.concat(F.col(ids), F.array_repeat(F.lit(PAD_ID), pad)))
        .withColumn("labels", F.concat(F.col(labels), F.array_repeat(F.lit(IGNORE_LABEL), pad)))
        .withColumn(
            "attention_mask",
            F.concat(F.array_repeat(F.lit(1.0).cast("float"), n), F.array_repeat(F.lit(0.0).cast("float"), pad)),
        )
        .drop("_len")
    )
