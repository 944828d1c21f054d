"""Executors need not have this package on their path."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows:", len(contract.queries()["op8_url_filter"](spark, {sf_dir!r}).collect()))
"""


def test_queries_run_where_the_package_is_not_installed(tmp_path, sf_dir):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=str(Path(__file__).parents[2]), sf_dir=sf_dir))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "rows: 50" in done.stdout, done.stderr[-2000:]
