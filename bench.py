"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.  Each query is fully evaluated with a ``noop`` write,
so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = [
    "flagship",
    "ingest_status_a",
    "ingest_status_b",
    "segments_dotall",
    "layout_a_entries",
    "image_lookup",
    "images_collected",
    "on_missing_modes",
    "global_index",
    "train_test_split",
    "shard_manifest",
    "unified_layouts",
    "reject_reasons",
    "sequence_plan",
    "token_pairs",
    "padded_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="tessera-bench")
    queries = catalog.all_queries()
    names = only or HEADLINE
    # Untimed warm-up on the smallest tables: JIT, codegen caches, Python workers.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in names:
            queries[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup": warm_dir if os.path.isdir(warm_dir) and warm_dir != sf_dir else None,
        "note": "each query fully executed from parquet (noop sink); view plans shared per session",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
