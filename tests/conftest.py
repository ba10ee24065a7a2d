import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(4, shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture()
def one_col(spark):
    """Build a one-column string DataFrame from Python values."""

    def make(values, name="t"):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, {name} string")

    return make
