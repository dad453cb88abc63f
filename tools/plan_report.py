"""Summarise the executed physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is run once (collected), then its final adaptive plan is
inspected: scans, shuffles, reused exchanges, join and aggregate kinds,
and the filters pushed into parquet scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402

NODES = [
    ("scans", "FileScan parquet"), ("shuffles", "Exchange hashpartitioning"),
    ("round-robin", "Exchange RoundRobinPartitioning"), ("reused", "ReusedExchange"),
    ("bcast", "BroadcastExchange"), ("SMJ", "SortMergeJoin"), ("BHJ", "BroadcastHashJoin"),
    ("SHJ", "ShuffledHashJoin"), ("BNLJ", "BroadcastNestedLoopJoin"), ("HashAgg", "HashAggregate("),
    ("ObjHashAgg", "ObjectHashAggregate("), ("SortAgg", "SortAggregate("), ("Window", "Window ["),
    ("GroupLimit", "WindowGroupLimit"), ("Generate", "Generate "), ("PyUDF", "PythonUDF"),
]


DETAIL = ["district_mart", "span_extrema", "effectiveness_report"]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def row(name: str, plan: str) -> str:
    return f"| {name} | " + " | ".join(str(plan.count(token)) for _, token in NODES) + " |"


def table(spark, sf_dir, pushed) -> None:
    """A row per query, and one per stage that was stored for it before."""
    stages = []
    store = catalog.materialize

    def recorded(df, name="stage"):
        out = store(df, name)
        stages.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return out

    catalog.materialize = recorded
    print("| query | " + " | ".join(n for n, _ in NODES) + " |")
    print("| --- | " + " | ".join("---" for _ in NODES) + " |")
    seen = set()
    for name, fn in sorted(catalog.QUERIES.items()):
        del stages[:]
        plan = final_plan(fn(spark, sf_dir))
        print(row(name + ("" if not stages else f" (after {', '.join(n for n, _ in stages)})"), plan))
        pushed[name] = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        for stage, before in stages:
            if stage not in seen:
                seen.add(stage)
                print(row(f"stored stage {stage} (plan before run)", before))
    catalog.materialize = store


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Counts of plan nodes in the final executed plan; `reused` exchanges are computed once. Stages that a")
    print("query stores first are named with it and have a row of their own where they occur first.\n")
    pushed = {}
    table(spark, sf_dir, pushed)
    print("\n## Without automatic broadcast joins\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    table(spark, sf_dir, {})
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    print("\n## Filters pushed into parquet scans\n")
    for name, filters in pushed.items():
        if filters:
            print(f"* `{name}`: " + "; ".join(f"`{f}`" for f in filters))
    for name in DETAIL:
        print(f"\n## Final plan: `{name}`\n\n```\n{final_plan(catalog.QUERIES[name](spark, sf_dir)).strip()}\n```")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
