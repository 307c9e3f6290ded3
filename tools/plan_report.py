"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [--sf DIR] [--broadcast] > PLANS.md

By default broadcasts are disabled, which shows the sort-merge plans a large
input gets. For each query: number of shuffle exchanges, broadcast exchanges,
Expand (exact distinct counts), sort-based aggregates, windows, and the read
schema / pushed filters of every scan. Writing queries (sources, sinks) run
their writes while being planned; their plan is that of the returned frame.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = []
    for block in re.findall(r"\(\d+\) Scan \w+.*?(?=\n\(\d+\)|\Z)", plan, flags=re.S):
        loc = re.search(r"Location: \w+ \[(.*?)\]", block)
        schema = re.search(r"ReadSchema: (.*)", block)
        pushed = re.search(r"PushedFilters: (.*)", block)
        scans.append((os.path.basename((loc.group(1) if loc else "?").split(",")[0]),
                      schema.group(1) if schema else "",
                      pushed.group(1) if pushed else ""))
    head = plan.split("\n\n")[0]
    # Node details: "(n) Exchange ... Arguments: hashpartitioning(...)".
    shuffles = re.findall(r"\(\d+\) (?:Exchange|ShuffleQueryStage)[^\n]*\n(?:[^\n]+\n)*?"
                          r"Arguments: (hashpartitioning|rangepartitioning|roundrobinpartitioning)",
                          plan)
    return {
        "exchanges": len(shuffles),
        "broadcasts": len(re.findall(r"BroadcastExchange", head)),
        "expand": len(re.findall(r"\bExpand\b", head)),
        "sort_aggregate": len(re.findall(r"SortAggregate", head)),
        "window": len(re.findall(r"\bWindow\b", head)),
        "scans": scans,
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--broadcast", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from ledgerline.queries import QUERIES
    from ledgerline.session import get_session

    conf = {} if args.broadcast else {"spark.sql.autoBroadcastJoinThreshold": "-1",
                                      "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = get_session("local[4]", shuffle_partitions=8, extra_conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Planned with `tools/plan_report.py` on {os.path.basename(args.sf)}, broadcasts "
          f"{'enabled' if args.broadcast else 'disabled (the sort-merge shape of large inputs)'}. "
          "Shuffles count hash/range exchanges (not the single-partition exchange of a final "
          "global aggregate). Scan columns are the pruned `ReadSchema`.\n")
    print("| query | shuffles | broadcasts | expand | sort agg | window | scans (columns read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in args.names or list(QUERIES):
        df = QUERIES[name](spark, args.sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summarise(plan)
        scans = "<br>".join(
            f"{f}: {re.sub(r'struct<|>$', '', sch).replace(':', ' ')}"
            + (f"; {p}" if p and p != "[]" else "") for f, sch, p in s["scans"])
        print(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['expand']} | "
              f"{s['sort_aggregate']} | {s['window']} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
