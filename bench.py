"""Benchmark: run every driver query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely (``write.format('noop')``: every row is
produced, nothing is collected).  One warm-up pass over all queries, then
$BENCH_REPEAT timed rounds over all queries in turn; the median per query.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cabline.plans.queries import QUERIES
    from cabline.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="cabline-bench",
                      shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = only or list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:                      # warm-up: every query once, JIT included
        run(name)
    runs = {name: [] for name in names}
    for _ in range(repeat):                 # timed rounds over all queries in turn
        for name in names:
            runs[name].append(run(name))
    times = {name: round(statistics.median(r), 3) for name, r in runs.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "repeat": repeat}))


if __name__ == "__main__":
    main()
