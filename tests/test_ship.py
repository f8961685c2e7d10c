"""Queries with Python functions run when workers start in another folder, without PYTHONPATH."""

import os
import subprocess
import sys

from conftest import SF

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {ENTRY!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("simplify_ladder", "self_intersections"):
    print("ROWS", name, entry.queries()[name](spark, {SF!r}).count())
"""


def test_udf_queries_run_away_from_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.count("ROWS") == 2
