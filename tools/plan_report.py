"""Summarise the physical plan of every registered query (no execution).

    python tools/plan_report.py [--sf /root/testdata/sf0.1] > PLANS.md

Per query: shuffles (exchanges), join strategies, windows and whether a
partial top-1 runs before the shuffle, aggregates, Python steps, and the
filters pushed into each Parquet scan.  Plans are the planner's before run
time; AQE may still turn a sort-merge join into a broadcast once it has
measured a side.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)[^\n]*?(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti)", plan)
    pushed = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*?Location: [^\n]*?/(\w+)\.parquet\][^\n]*?"
                        r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                    r"RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted({f"{a}/{b}" for a, b in joins}),
        "windows": plan.count("Window ["),
        "partial_top1": "WindowGroupLimit" in plan and ", Partial" in plan,
        "aggregates": len(re.findall(r"(Hash|ObjectHash|Sort)Aggregate\(", plan)) // 2,
        "python": "ArrowEvalPython" in plan or "BatchEvalPython" in plan,
        "pushed": sorted({f"{t}: {f[:60]}" for t, f in pushed if f}),
    }


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args(argv)

    from impactspark.plans.catalog import load_all
    from impactspark.session import build_session

    spark = build_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    qs = load_all()[0]
    print(f"# Physical plans of the registered queries ({os.path.basename(args.sf)}, before run time)\n")
    print("Generated by `tools/plan_report.py`.  Exchanges = shuffles; partial top-1 = "
          "`WindowGroupLimit` before the shuffle.\n")
    print("| query | shuffles | broadcasts | joins | windows | partial top-1 | aggregates | Python | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name in sorted(qs):
        try:
            plan = qs[name](spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | | | | |")
            continue
        s = summarise(plan)
        print(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{s['windows']} | {'yes' if s['partial_top1'] else '-'} | {s['aggregates']} | "
              f"{'yes' if s['python'] else '-'} | {'; '.join(s['pushed']) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
