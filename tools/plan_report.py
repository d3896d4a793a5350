"""Summarise the physical plans of the headline queries (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts, per query, the shuffles (hash/range/round-robin exchanges), broadcast
exchanges, partial window limits and file scans with their pushed filters,
from the plan Spark chose before execution (AQE may still shrink it).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bench import HEADLINE  # noqa: E402
from lakemart.plans.catalog import QUERIES  # noqa: E402
from lakemart.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"
                          r"\(([^)]*)", plan)
    scans = []
    for line in plan.splitlines():
        m = re.search(r"FileScan parquet \[(.*?)\].*?/([a-z]+)\.parquet\].*?PushedFilters: \[(.*?)\]", line)
        if m:
            cols, table, pushed = m.groups()
            scans.append((table, pushed, cols))
    return {
        "shuffles": [f"{k}({v.split('#')[0]}…)" if "#" in v else f"{k}({v})" for k, v in shuffles],
        "broadcasts": plan.count("BroadcastExchange"),
        "partial_limits": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "scans": [(t, len(cols.split(",")), bool(f.strip())) for t, f, cols in scans],
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print("# PLANS\n")
    print(f"Physical plans of the headline queries at `{sf}` (before AQE re-planning), from "
          "`tools/plan_report.py`. Shuffles list the first key of each exchange; scans give table, "
          "columns read and whether filters were pushed to Parquet.\n")
    print("| Query | Shuffles | Broadcasts | Partial window limits | Scans (table/columns/pushed) |")
    print("| --- | --- | --- | --- | --- |")
    for q in HEADLINE:
        if q not in QUERIES or q == "ml_fit":
            continue
        plan = QUERIES[q](spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans = ", ".join(f"{t}/{n}/{'y' if p else 'n'}" for t, n, p in s["scans"])
        print(f"| {q} | {len(s['shuffles'])}: {'; '.join(s['shuffles'])} | {s['broadcasts']} | "
              f"{s['partial_limits']} | {scans} |")


if __name__ == "__main__":
    main()
