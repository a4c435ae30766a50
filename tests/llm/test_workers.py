"""Python workers find the package when the driver was started elsewhere."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).parents[2]


def test_query_from_another_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from zoneflow.llm import catalog
assert catalog.QUERIES["op1_html"](spark, "/root/testdata/sf0.001").where("n_chars > 0").count() > 0
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True, cwd=tmp_path)
