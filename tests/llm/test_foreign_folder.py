"""Every query of the subpackage runs from another folder, where Python workers can't import
the package; a broken module of the subpackage isn't taken for a missing one."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LOAD = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("se", "{REPO}/__spark_entry__.py")
se = importlib.util.module_from_spec(spec); spec.loader.exec_module(se)
"""

SCRIPT = f"""
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
def found(_):
    import importlib.util
    yield importlib.util.find_spec("cabline") is not None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect() == [False]
{LOAD}
names = [n for n in se.queries() if n.startswith("op") or n == "pipeline"]
assert len(names) == 14
for name in names:
    assert se.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("ALL-RAN")
"""

BROKEN = f"""
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "cabline.llm.graph":
            raise ModuleNotFoundError("No module named 'cabline.llm.graph'", name=name)
sys.meta_path.insert(0, Missing())
try:
    {LOAD.strip().replace(chr(10), chr(10) + "    ")}
except ModuleNotFoundError as e:
    print("REPORTED", e.name)
"""


def run(script, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", script], cwd=str(folder), env=env,
                          capture_output=True, text=True, timeout=1500)


def test_all_queries_from_a_foreign_folder(tmp_path):
    out = run(SCRIPT, tmp_path)
    assert "ALL-RAN" in out.stdout, out.stderr[-3000:]


def test_a_broken_subpackage_is_reported(tmp_path):
    out = run(BROKEN, tmp_path)
    assert "REPORTED cabline.llm.graph" in out.stdout, out.stderr[-2000:]
