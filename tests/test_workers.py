"""Functions sent to Python workers must not need this package there."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from __spark_entry__ import queries
for n in ("autoregressive", "stream_nowcast", "stream_persistence"):
    assert queries()[n](spark, {sf!r}).limit(5).count() == 5
print("done")
"""


def test_plain_session_outside_the_repository(tmp_path, sf):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, sf=sf)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
