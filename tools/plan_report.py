"""Physical-plan shape of every registered query (for PLANS.md).

Usage: python tools/plan_report.py [--sf DIR] > PLANS.md
Counts shuffles, broadcasts, join strategies and aggregates in the initial adaptive plan and
lists each Parquet scan's read schema and pushed filters.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geomedallion.plans.workloads import WORKLOADS  # noqa: E402
from geomedallion.session import local_session  # noqa: E402

MARKS = [
    ("shuffle", "Exchange hashpartitioning"), ("round-robin", "Exchange RoundRobinPartitioning"),
    ("single", "Exchange SinglePartition"), ("broadcast", "BroadcastExchange"), ("BHJ", "BroadcastHashJoin"),
    ("SMJ", "SortMergeJoin"), ("window", "Window ["), ("hash-agg", "HashAggregate("),
    ("sort-agg", "SortAggregate("), ("obj-agg", "ObjectHashAggregate("),
    ("python", "Python"),
]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session(shuffle_partitions=16)
    print(f"# Physical plans (initial adaptive plans, `{a.sf}`)\n")
    print("Generated by `python tools/plan_report.py`. Counts are operator occurrences in the executed plan "
          "(subqueries included); `python` must stay 0.\n")
    print("| query | " + " | ".join(m for m, _ in MARKS) + " |")
    print("| --- |" + " --- |" * len(MARKS))
    scans = {}
    for name in a.names or WORKLOADS:
        df = WORKLOADS[name](spark, a.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| `{name}` | " + " | ".join(str(plan.count(s)) for _, s in MARKS) + " |")
        scans[name] = sorted(set(re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*/([\w.=-]+)\].*?"
                                            r"PushedFilters: \[([^\]]*)\], ReadSchema: (struct<[^>]*>)", plan)))
    print("\n## Parquet scans\n")
    for name, ss in scans.items():
        for f, pushed, schema in ss:
            print(f"- `{name}` · `{f}` · read `{schema}` · pushed `[{pushed}]`")


if __name__ == "__main__":
    main()
