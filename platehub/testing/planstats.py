"""Operator counts of every registered batch query's initial physical plan, with
broadcasts off as at scale (the table in PLANS.md):  ``python -m platehub.testing.planstats [SF_DIR]``."""

from __future__ import annotations

import os
import re
import sys

PATTERNS = {
    "scans": r"FileScan parquet",
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow\b",
}


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from platehub.plans.registry import QUERIES
    from platehub.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---" * (len(PATTERNS) + 1) + "|")
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(counts) + " |")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
