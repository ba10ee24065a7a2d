"""Print the physical plans of registered queries (after execution, so AQE's
final choices show).

    python -m tessera.plans.explain /root/testdata/sf0.01 flagship ingest_status_b
"""

from __future__ import annotations

import re
import sys

from ..session import local_session
from . import catalog

KEEP = re.compile(r"(Exchange|Join|Aggregate|Scan|Window|Generate|BroadcastExchange|Sort |TakeOrdered|Union|"
                  r"Expand|AQEShuffleRead|ReusedExchange|Filter|MapInArrow|ArrowEval|BatchEval)")


def condensed(df) -> str:
    """Operator lines of the executed plan, without expression details."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        head = re.split(r"[\[(]", line, maxsplit=1)[0].rstrip()
        if KEEP.search(head):
            extra = ""
            m = re.search(r"(hashpartitioning\([^,]+|rangepartitioning\([^,]+|ReadSchema: struct<[^>]*>)", line)
            if m:
                extra = "  " + m.group(1)[:90]
            lines.append(head + extra)
    return "\n".join(lines)


def main(argv: list[str]) -> None:
    sf_dir, names = argv[0], argv[1:]
    spark = local_session(8, shuffle_partitions=16)
    queries = catalog.all_queries()
    for name in names or sorted(queries):
        df = queries[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"## {name}\n\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
