"""Print a one-line plan summary per registered query (sf dir as argv[1])."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.queries import QUERIES  # noqa: E402
from quayside.session import local_session  # noqa: E402

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
       "MapInPandas", "Window")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print(f"| query | exchanges | broadcasts | sort aggregates | scans (ReadSchema) |")
    print("| --- | --- | --- | --- | --- |")
    for name in sys.argv[2:] or QUERIES:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ex = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + \
            plan.count("Exchange SinglePartition") + plan.count("Exchange RoundRobin")
        bad = [b for b in BAD if b in plan]
        schemas = re.findall(r"ReadSchema: struct<([^>\n]*)", plan)
        assert not bad, (name, bad)
        cols = "; ".join(s.rstrip(".") or "(row count only)" for s in schemas) or "(no data scan: schema metadata, or a table the query wrote)"
        print(f"| {name} | {ex} | {plan.count('BroadcastExchange')} | {plan.count('SortAggregate')} | {cols} |")
    spark.stop()


if __name__ == "__main__":
    main()
