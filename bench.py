"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver). One warm-up query runs first so JVM start-up
and code loading are not billed to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_matrix",
    "feature_job_wide",
    "melt_sales",
    "cv_metrics",
    "allocate_ordered",
    "allocation_orders",
    "replay_ledger",
    "daily_kpis",
    "compare_policies",
    "warehouse_drawdown",
    "open_positions",
    "policy_kpis",
    "read_prices_folder",
    "gbt_forecast",
    "gbt_cv_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from larder.catalog.queries import QUERIES
    from larder.plans.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus) * 2)
    QUERIES["initial_stock"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
