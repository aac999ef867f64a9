"""The driver may load __spark_entry__ by file path from any directory: the
executors' Python workers must still import the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", E.queries()["score_batch"](s, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 500" in out.stdout, out.stderr[-2000:]
