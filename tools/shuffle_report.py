"""Measured stages, tasks, input and shuffle bytes of every driver query.

Usage: python tools/shuffle_report.py [--sf DIR] [name ...]

Runs each query once in full (``noop`` sink) in a session that writes Spark's
event log to a new scratch folder, then reads the log back.  The rows a query
shuffles per row it reads is what grows into network and disk traffic at
100 TB.  The width probe of the ordered scans runs as its own job and is
counted with its query; input rows count every scan of a table.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

METRICS = {
    "internal.metrics.input.recordsRead": "input_rows",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.write.recordsWritten": "shuffle_records",
    "internal.metrics.executorRunTime": "run_ms",
}


def _lines(path: str):
    """Event log lines; a rolled log is a folder of files read in order."""
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    for f in files:
        if os.path.basename(f).startswith("appstatus"):
            continue
        with open(f) as fh:
            yield from fh


def read_log(path: str) -> dict[str, dict[str, float]]:
    """Per job group: stages, tasks and summed stage metrics."""
    stage_group, out = {}, defaultdict(lambda: defaultdict(float))
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            group = stage_group.get(info["Stage ID"])
            if group is None:
                continue
            acc = out[group]
            acc["stages"] += 1
            acc["tasks"] += info.get("Number of Tasks", 0)
            for a in info.get("Accumulables", []):
                name = METRICS.get(a.get("Name"))
                if name:
                    acc[name] += float(a.get("Value") or 0)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()

    from cabline.plans.queries import QUERIES
    from cabline.session import get_spark
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = get_spark("local[8]", app="cabline-shuffle-report", shuffle_partitions=16,
                      extra={"spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": "file://" + log_dir,
                             "spark.eventLog.compress": "false",
                             "spark.ui.showConsoleProgress": "false"})
    names = args.names or list(QUERIES)
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, args.sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    (path,) = glob.glob(os.path.join(log_dir, "*"))
    stats = read_log(path)
    mb = 1 << 20
    print(f"{'query':28s} {'stages':>6s} {'tasks':>6s} {'input rows':>10s} {'shuffled rows':>13s} "
          f"{'per input row':>13s} {'shuffle MB':>10s}")
    for name in names:
        s = stats.get(name, {})
        rows_in, rows_sh = s.get("input_rows", 0.0), s.get("shuffle_records", 0.0)
        ratio = f"{rows_sh / rows_in:.2f}" if rows_in else "-"
        print(f"{name:28s} {int(s.get('stages', 0)):6d} {int(s.get('tasks', 0)):6d} "
              f"{int(rows_in):10d} {int(rows_sh):13d} {ratio:>13s} "
              f"{s.get('shuffle_write', 0.0) / mb:10.2f}")
    print(f"(event log: {path})")


if __name__ == "__main__":
    main()
