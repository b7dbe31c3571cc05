"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and written to the ``noop`` sink (full execution, no
output I/O): one warm-up, then the median of $BENCH_RUNS timed runs.
Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from rollbook.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="rollbook-bench")
    spark.sparkContext.setLogLevel("ERROR")

    from rollbook.catalog import QUERIES

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "sink": "noop",
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
