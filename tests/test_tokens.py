"""Token path: default hash tokenizer, pluggable tokenizer, budget."""

from pyspark.sql import functions as F

from tessera.operators import tokens as TK


def test_hash_tokenizer_splits_like_python(spark):
    texts = ["a  b\tc\n", "", "　x\xa0y\x1cz", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.n for r in df.select("id", F.size(TK.hash_tokenize(F.col("t"))).alias("n")).collect()}
    assert got == {i: len(t.split()) for i, t in enumerate(texts)}


def test_truncation(spark):
    df = spark.createDataFrame([(" ".join(["w"] * 5000),)], "t string")
    assert df.select(F.size(TK.hash_tokenize(F.col("t")))).collect()[0][0] == TK.MAX_LENGTH


def test_pluggable_tokenizer(spark):
    enc = TK.pandas_tokenizer(lambda s: [ord(c) for c in s], max_length=3)
    df = spark.createDataFrame([("abcd",), ("",)], "t string")
    assert [r.ids for r in df.select(enc(F.col("t")).alias("ids")).collect()] == [[97, 98, 99], []]


def test_budget_counts_both_sides(spark):
    df = spark.createDataFrame([(1, [1] * 5), (2, [1] * 50)], "k long, tokens array<int>")
    kept, over = TK.token_budget_filter(df, max_tokens=10)
    assert kept.count() == 1 and over.count() == 1
