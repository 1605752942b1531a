"""Shuffle, broadcast, sort and window counts of every driver query's physical plan.

Usage: python tools/plans.py [--sf DIR] [--aqe] [--no-broadcast] [--show] [name ...]

By default AQE is off, so the printed plan is the one Spark starts from
(``df.explain()``); ``--no-broadcast`` shows the plans large inputs get.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict[str, int]:
    lines = plan.splitlines()
    shuffle = re.compile(r"Exchange (hash|range)partitioning|Exchange SinglePartition")
    return {
        "shuffles": sum(1 for x in lines if shuffle.search(x) and "ReusedExchange" not in x),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": plan.count("Sort ["),
        "windows": plan.count("Window ["),
        "scans": plan.count("FileScan parquet"),
        "python": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--aqe", action="store_true")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("--show", action="store_true", help="print the formatted plans too")
    args = ap.parse_args()

    from cabline.plans.queries import QUERIES
    from cabline.session import get_spark
    spark = get_spark("local[8]", app="cabline-plans", shuffle_partitions=16,
                      extra={"spark.ui.showConsoleProgress": "false"})
    spark.conf.set("spark.sql.adaptive.enabled", str(args.aqe).lower())
    if args.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in args.names or list(QUERIES):
        df = QUERIES[name](spark, args.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = " ".join(f"{k}={v}" for k, v in summarize(plan).items())
        print(f"{name:28s} {counts}")
        if args.show:
            df.explain("formatted")


if __name__ == "__main__":
    main()
