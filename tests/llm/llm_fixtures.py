"""Shared fixtures: odd documents and labels."""

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd case: nulls, empty and long texts, ties,
    repeated rows, and columns named like the operators' own."""
    passage = " ".join(f"shared{i}" for i in range(60))
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(20000))
    base = " ".join(f"word{i * 7 % 41}" for i in range(80))
    rows = [
        (1, f"first start {passage} first end", "a"), (2, f"second {passage}\tsecond\n\nend", "a"), (2, f"second {passage}\tsecond\n\nend", "a"),
        (3, None, None), (4, "", "b"), (5, " \n\t ", "b"), (6, "one", None), (None, f"no id {passage}", "a"), (None, None, None),
        (7, long_text, "a"), (8, long_text + " tail", "c"), (9, base, "c"), (10, base, "c"), (11, base.replace("word3 ", "other "), "a"),
        (2, "same id, other text " + base[:200], "b"), (12, "x " * 40, "a"), (13, "café   naïve   \U0001f600 \n\nend <|endoftext|> z ", "c"),
        (14, "line\nline\n\nline\n" + " ".join("abcdefgh") + " " + " ".join("abcdefgh"), "a"),
    ]
    schema = "doc_id long, text string, source string, n_words long, kept boolean, node long, _row long, grp int"
    return spark.createDataFrame([(*r, 5, False, 1, 2, 3) for r in rows], schema)


@pytest.fixture(scope="session")
def read_docs(odd_docs, spark, tmp_path_factory):
    """The same, read from files."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    odd_docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(read_docs):
    return read_docs.limit(0)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (2, 1, None), (9, 1, 0), (10, 0, 0), (None, 1, 0), (12, None, 1), (7, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
