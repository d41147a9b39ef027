"""Sessions without spark.checkpoint.dir, which this container presets: they need a process of their own."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

CODE = """
from pyspark.sql import SparkSession
from lumenreel.llm import common
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None, "preset"
one, two = (common.stored(spark.range(n), "t") for n in (3, 4))
assert one.count() == 3 and two.count() == 4
assert common.shared_dir(spark) == common.shared_dir(spark)
common.discard(one, two)
print("stored", common.shared_dir(spark))
"""


def test_a_local_session_without_the_setting(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(ROOT), "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert f"stored {tmp_path}" in run.stdout
