"""The driver contract works from a plain session started in another directory
(Python workers cannot import the package from the repository)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("se", "{REPO}/__spark_entry__.py")
se = importlib.util.module_from_spec(spec); spec.loader.exec_module(se)
assert se.entry(spark).count() > 0
assert se.queries()["cell_traffic"](spark, "/root/testdata/sf0.001").count() > 0
print("CONTRACT-OK")
"""


def test_entry_and_udf_query_from_foreign_cwd(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-3000:]


def test_bench_prints_one_json_line(tmp_path):
    import json
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env.update({"BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_REPEAT": "1",
                "BENCH_QUERIES": "measurement_points,hourly_max_tips",
                "BENCH_DRIVER_MEMORY": "2g"})
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], cwd=str(tmp_path),
                         env=env, capture_output=True, text=True, timeout=600)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"measurement_points", "hourly_max_tips"}
    assert result["value"] == round(sum(result["queries"].values()), 3)


def test_shuffle_report_reads_its_event_log(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, os.path.join(REPO, "tools", "shuffle_report.py"),
                          "--sf", "/root/testdata/sf0.001", "hourly_tips", "measurement_points"],
                         cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=600)
    rows = {line.split()[0]: line.split() for line in out.stdout.splitlines()
            if line.startswith(("hourly_tips", "measurement_points"))}
    assert set(rows) == {"hourly_tips", "measurement_points"}, out.stdout + out.stderr[-2000:]
    assert int(rows["hourly_tips"][3]) == 1000          # input rows of events at sf0.001
    assert int(rows["hourly_tips"][4]) > 0               # it shuffles
    assert int(rows["measurement_points"][4]) == 0       # map-only
