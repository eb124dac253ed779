"""Benchmark the headline jobs.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5), BENCH_WARMUP (untimed runs first, default 2),
BENCH_QUERIES (comma list, default the headline set).

Each run executes the full plan into Spark's ``noop`` sink (no driver
collect). Prints ONE JSON line: per-query median seconds and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carecast.registry import queries  # noqa: E402
from carecast.session import local_session  # noqa: E402

HEADLINE = ["demand_vs_capacity", "covid_daily", "movement_detail", "shift_demand",
            "visit_classification"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=max(2, cpus), app="carecast-bench")
    qs = queries()
    def once(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm every query first (JIT, class loading), so none pays for running first;
    # each timed run still builds and plans its query from scratch.
    for _ in range(warmup):
        for name in names:
            once(name)
    timings = {name: round(statistics.median(once(name) for _ in range(runs)), 4) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "warmup": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
