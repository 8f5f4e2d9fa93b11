"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 1: best of N timed runs after one warm-up run).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# fixed value: the headline queries named by the performance record
HEADLINE = ["urban_growth", "group_stats", "sum_two_keys", "km_curve", "parallel_group_analysis",
            "linreg_fit", "rf_confusion"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    from tessera.plans.catalog import QUERIES
    from tessera.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tessera-bench")
    # warm-up on the smallest tables: JVM JIT, codegen caches, Python workers.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir).collect()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        best = None
        for _ in range(max(1, reps)):
            t0 = time.perf_counter()
            n = len(QUERIES[name](spark, sf_dir).toPandas())  # Arrow transfer to the driver
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = n
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
