import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
from pyspark.sql import SparkSession
from devmetrics.plans.staging import shared_folder, stage

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
folder = shared_folder(spark)
assert shared_folder(spark).startswith("file:") and folder in shared_folder(spark)
assert stage(spark.range(3)).count() == 3
"""


def test_a_local_session_without_the_setting_gets_a_folder(tmp_path):
    # An empty folder of settings: the machine's own may name a checkpoint folder.
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, env=env, check=True, timeout=300)
