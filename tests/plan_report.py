"""Summarise the final (adaptive) physical plan of every registered query.

    python tests/plan_report.py [sf_dir] > PLANS.md

Each query is run once (collect), then its executed plan is inspected:
shuffle exchanges (hash / range / single), reused exchanges, broadcasts,
scans with their pushed filters and read schema, windows, aggregates, and
any cross join.  Queries that write a table inside the call (upserts,
ingest, streams) report the plan of the final read only.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    # An adaptive plan prints its final plan, then the initial one.
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    lines = plan.splitlines()
    def n(pat):
        return sum(1 for l in lines if re.search(pat, l))
    scans = []
    for l in lines:
        m = re.search(r"FileScan (\w+) \[([^\]]*)\]", l)
        if m:
            extra = []
            for key in ("PartitionFilters", "PushedFilters"):
                k = re.search(key + r": \[([^\]]*)\]", l)
                if k and k.group(1):
                    extra.append(f"{key}=[{k.group(1)[:60]}]")
            scans.append(f"{m.group(1)}({m.group(2)[:50]}){' ' + ' '.join(extra) if extra else ''}")
    return {
        "hash_exchange": n(r"Exchange hashpartitioning") - n(r"ReusedExchange.*hashpartitioning"),
        "range_exchange": n(r"Exchange rangepartitioning"),
        "single_exchange": n(r"Exchange SinglePartition"),
        "reused": n(r"ReusedExchange"),
        "broadcast": n(r"BroadcastExchange"),
        "window": n(r"\bWindow \["),
        "partial_agg": n(r"partial_"),
        "cross": n(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "scans": scans,
    }


def main(argv):
    from loomlog.plans import catalog
    from loomlog.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans at `{sf_dir}` (local[8], AQE on), produced by "
          "`tests/plan_report.py`.  Columns count operators in the executed plan; "
          "`partial agg` counts map-side partial aggregate functions; `cross` must be 0.\n")
    print("| query | hash exch. | range exch. | single | reused | broadcast | window | partial agg | cross | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, (fn, _) in catalog.REGISTRY.items():
        df = fn(spark, sf_dir)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        scans = "; ".join(s["scans"]).replace("|", "\\|")
        print(f"| `{name}` | {s['hash_exchange']} | {s['range_exchange']} | {s['single_exchange']} | "
              f"{s['reused']} | {s['broadcast']} | {s['window']} | {s['partial_agg']} | {s['cross']} | {scans} |",
              flush=True)


if __name__ == "__main__":
    main(sys.argv)
