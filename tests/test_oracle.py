"""Every registered query against its DuckDB oracle on the smallest tables."""

import re

import pytest

from conftest import SF_SMALL
from harness import compare, duck

import __spark_entry__ as E

SQL = E.oracle_sql()
# the corpus operators and the pipeline have tests of their own in tests/llm
NAMES = sorted(n for n in E.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    if name not in SQL:
        assert fn(spark, SF_SMALL).count() >= 0
        return
    ok, ns, nd, detail = compare(spark, name, fn, SQL[name], SF_SMALL, con)
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["task_id", "pos", "type", "content", "image_index", "image_length"]


def test_every_query_has_oracle_or_is_declared_rows_only():
    assert set(NAMES) <= set(SQL)
