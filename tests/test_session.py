"""A plain install: no Spark defaults at all, as in a fresh virtual environment."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from lifeboat.session import checkpoint_root, local_session, scratch_path
from lifeboat.operators.layout import stage
spark = local_session(cores=1, shuffle_partitions=1)
root = checkpoint_root(spark)
assert root == checkpoint_root(spark) and scratch_path(spark, "a").startswith(root)
assert stage(spark.range(3)).count() == 3
print("staged under", root)
"""


def test_staging_without_spark_defaults(tmp_path):
    """No spark.checkpoint.dir anywhere: a local session gets one folder and keeps it."""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=Path(__file__).resolve().parents[1],
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "staged under" in run.stdout
