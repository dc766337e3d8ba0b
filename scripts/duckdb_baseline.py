"""Time each query's oracle SQL in DuckDB (single node) for orientation.

    python scripts/duckdb_baseline.py [sf_dir] [runs] [threads]

Prints one JSON line like bench.py: median seconds per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    threads = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    from tarmac.plans import ORACLE

    con = duckdb.connect()
    con.execute(f"SET threads TO {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    for name, sql in ORACLE.items():
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    print(json.dumps({"metric": "duckdb_sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf_dir": sf_dir, "threads": threads,
                      "duckdb": duckdb.__version__}))


if __name__ == "__main__":
    main()
