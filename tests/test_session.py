"""Scratch storage on a local Spark where nothing is configured."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from clickloom.session import materialise

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
from pyspark.sql import SparkSession
from clickloom.session import materialise
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
print("rows", materialise(spark.range(7), "seven").count())
"""


def test_tables_are_stored_without_a_checkpoint_setting(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(ROOT)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "rows 7" in done.stdout, done.stderr[-2000:]


def test_a_table_of_vectors_is_stored_in_files_of_bounded_rows(spark):
    rows = spark.range(0, 2_500, 1, 1).select("id", F.array_repeat(F.lit(0.5), 64).alias("v"))
    stored = materialise(rows, "vectors", 1_000)
    assert len(stored.inputFiles()) == 3 and stored.select("id").distinct().count() == 2_500
    assert len(materialise(rows, "vectors").inputFiles()) == 1
