import os
import subprocess
import sys

CODE = r"""
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.sparkContext.getCheckpointDir() is None
n = e.queries()["fill_group_median"](spark, "/root/testdata/sf0.001").count()
assert n == 200, n
print("OK", n, spark.sparkContext.getCheckpointDir() is not None)
"""


def test_queries_run_in_a_session_without_checkpoint_dir():
    import tempfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="empty-conf-"))  # no defaults
    out = subprocess.run([sys.executable, "-c", CODE], cwd=root, capture_output=True, text=True,
                         timeout=600, env=env)
    assert out.returncode == 0 and "OK 200 True" in out.stdout, out.stderr[-3000:]
