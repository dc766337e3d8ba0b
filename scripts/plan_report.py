"""Summarise the executed physical plans of each registered query into PLANS.md.

    python scripts/plan_report.py [sf_dir] > PLANS.md

Counts go over *all* executions of a query - writes, checkpoints and
micro-batches included - taken from the session's event log.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "scripts")]

from plan_log import PlanLog, log_conf  # noqa: E402

from tarmac.session import build_session  # noqa: E402


def summarise(plans: list[str]) -> dict:
    plan = "\n".join(plans)
    reads = set()
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[file:([^\],]*)", plan):
        path = m.group(3).rstrip("/")
        hit = re.search(r"/tarmac/([a-z0-9_]+)-[0-9a-f]+", path)
        table = f"scratch:{hit.group(1)}" if hit else os.path.basename(path).replace(".parquet", "")
        reads.add(f"{table}({len([c for c in m.group(2).split(',') if c])})")
    return {
        "executions": len(plans),
        "shuffles": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "1-part": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "SMJ": plan.count("SortMergeJoin"), "BHJ": plan.count("BroadcastHashJoin"),
        "sort agg": plan.count("SortAggregate"),
        "pushed filter": "yes" if re.search(r"(?:PushedFilters|PartitionFilters): \[[^\]\s]", plan) else "",
        "partial agg": "yes" if "partial_" in plan else "",
        "partial group limit": "yes" if re.search(r"WindowGroupLimit .*Partial", plan) else "",
        "reads": " ".join(sorted(reads))}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tarmac.plans import QUERIES

    spark = build_session("local[8]", 8, extra=log_conf())
    log = PlanLog(spark)
    rows = {}
    for name, fn in QUERIES.items():
        log.new_plans()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        rows[name] = summarise(log.new_plans())
    print("# PLANS\n")
    print(f"Executed plans (as adaptive execution ended them) of every query of `tarmac/plans` at `{sf_dir}`,")
    print("from the event log, by `scripts/plan_report.py`. Counts go over all executions of a query: table")
    print("writes, checkpoints and micro-batches included. *1-part* are exchanges to a single partition (global")
    print("aggregates and per-partition offset tables, all bounded); *reads* lists scanned tables with the number")
    print("of columns read, `scratch:` being what the query wrote itself.\n")
    columns = list(next(iter(rows.values())))
    print("| query | " + " | ".join(columns) + " |")
    print("|---|" + "---|" * len(columns))
    for name, r in rows.items():
        print(f"| {name} | " + " | ".join(str(r[c]) for c in columns) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
