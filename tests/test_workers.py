"""Python workers started outside the repository run the library's tasks:
their code is shipped with them."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
from __spark_entry__ import queries
for name in {names!r}:
    print("ROWS", name, len(queries()[name](spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


def run_elsewhere(tmp_path, names):
    script = SCRIPT.format(repo=REPO, folder=str(tmp_path / "ckpt"), names=names)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=1200)
    assert [x.split()[1] for x in out.stdout.splitlines() if x.startswith("ROWS")] == names, out.stderr[-3000:]


def test_survey_queries_without_the_package_on_the_workers(tmp_path):
    run_elsewhere(tmp_path, ["survey_prop_select_one", "survey_prop_packed", "survey_mean", "audit_log"])
