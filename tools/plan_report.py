"""Summarise the executed (final AQE) plans of the headline queries.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For every query: the exchanges by kind, the join strategies, reused
exchanges, Expand / Window operators, and the scans' read columns and pushed
filters.  Counts come from the final adaptive plan after one execution.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    kinds = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    return {
        "hash exchanges": kinds.count("hashpartitioning"),
        "range exchanges": kinds.count("rangepartitioning"),
        "single-partition exchanges": kinds.count("SinglePartition"),
        "round-robin exchanges": kinds.count("RoundRobinPartitioning"),
        "reused exchanges": plan.count("ReusedExchange"),
        "broadcast hash joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "nested-loop/cartesian": plan.count("NestedLoopJoin") + plan.count("CartesianProduct"),
        "Expand": plan.count("Expand ["),
        "Window": plan.count("Window ["),
        "Generate": plan.count("Generate "),
        "read columns": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
        "pushed filters": sorted(set(f for f in re.findall(r"PushedFilters: (\[[^\]]*\])", plan) if f != "[]")),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from threadlens.plans.catalog import QUERIES
    from threadlens.session import build_session

    spark = build_session()
    print(f"# Executed plans of the headline queries ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`; counts are from the final adaptive plan.\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {name}\n")
        counts = ", ".join(f"{k}: {v}" for k, v in s.items() if isinstance(v, int) and v)
        print(f"- {counts or 'no exchanges'}")
        for col in s["read columns"]:
            print(f"- scan reads `{col}`")
        for f in s["pushed filters"]:
            print(f"- pushed filters `{f}`")
        print()


if __name__ == "__main__":
    main(sys.argv)
