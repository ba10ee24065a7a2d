"""Physical-plan properties the design relies on."""

from conftest import SF_MID
from tessera.operators import order as O
from tessera.operators.images import image_index
from tessera.plans import catalog as C
from tessera.sources import fixtures as X


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_index_has_no_single_partition_window_over_rows(spark):
    """Unpartitioned windows only run over the per-bucket counts (an
    Aggregate); the rows are numbered in windows partitioned by bucket, and
    there is a single exchange of the rows (no range exchange)."""
    import re

    for df in (O.global_index(C.orders(spark, SF_MID).select("o_orderkey"), ["o_orderkey"]),
               O.shuffle(C.orders(spark, SF_MID).select("o_orderkey"), "o_orderkey", 42)):
        opt = df._jdf.queryExecution().optimizedPlan().toString()
        blocks = opt.split("Window [")[1:]
        assert blocks
        for block in blocks:
            first_line = block.split("\n")[0]
            partition_spec = re.findall(r"\], \[([^\]]*)\], \[", first_line)
            if not partition_spec or partition_spec[0].strip() == "":
                assert "Aggregate" in block.split("+- Window")[0]
        physical = _plan(df)
        assert "rangepartitioning" not in physical


def test_status_scan_prunes_image_bytes(spark):
    """Existence checks read ``path`` only; bytes stay in the scan of the
    validity index (which needs them) and never reach the status joins."""
    blobs = X.image_blobs(spark, SF_MID)
    plan = blobs.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_core_has_no_python_udf(spark):
    for name in ["ingest_status_a", "ingest_status_b", "sequence_plan", "token_pairs", "flagship", "train_test_split"]:
        plan = _plan(C.all_queries()[name](spark, SF_MID))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_reach_the_scan(spark):
    df = C.orders(spark, SF_MID).filter("o_orderkey < 100").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in df._jdf.queryExecution().executedPlan().toString()


def test_image_index_reads_each_blob_once(spark):
    plan = _plan(image_index(X.image_blobs(spark, SF_MID)))
    assert plan.count("FileScan parquet") == 1


def test_no_cartesian_or_python_in_registered_queries(spark):
    """Every registered query: no cartesian / nested-loop join, and Python
    only where declared (the footer reader)."""
    import __spark_entry__ as E

    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF_MID))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name != "footer_info":
            assert "Python" not in plan and "ArrowEval" not in plan, name
