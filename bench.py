"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

warm-up runs, then BENCH_RUNS timed runs (default 5); each query's time is
the median. A query is forced with the `noop`
sink, so the whole plan runs but nothing is collected to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "agg_10": "flagship: readings -> hourly features",
    "agg_01": "hourly mean",
    "snk_01": "insert-if-absent",
    "ml_04": "exact 7-nearest-neighbour mean",
    "agg_03": "hourly first non-null",
    "jon_01": "not-exists anti join",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from wattline.session import get_session
    from wattline.plans.catalog import QUERIES
    spark = get_session(f"local[{cpus}]", cpus, app_name="wattline-bench", driver_memory="16g")

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for name in HEADLINE:
        once(name)  # warm-up
        once(name)
        results[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
