import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
from pyspark.sql import SparkSession
from devmetrics.llm.staging import Workspace

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
work = Workspace(spark)
assert work.write(spark.range(3), "three").count() == 3
assert Workspace(spark).root.rpartition("/")[0] in (work.root.rpartition("/")[0], spark.sparkContext.getCheckpointDir() + "/devmetrics-llm")
"""


def test_a_local_session_without_the_setting_gets_a_folder(tmp_path):
    # An empty folder of settings: the machine's own may name a checkpoint folder.
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, env=env, check=True, timeout=300)
