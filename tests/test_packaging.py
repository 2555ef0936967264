"""Queries whose plans run Python on executors (applyInPandas,
mapInPandas) work when the driver imports the entry point from another
working directory: the package is shipped to the Python workers."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for n in ["ts_ar_p", "udtf_group_closure"]:
    print(n, len(e.queries()[n](spark, "/root/testdata/sf0.001").collect()))
"""


def test_python_workers_import_the_package():
    with tempfile.TemporaryDirectory() as cwd:
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True, text=True, timeout=600,
                           env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    out = r.stdout.replace("\r", "\n")
    assert "ts_ar_p 75" in out and "udtf_group_closure 3" in out, (out[-500:], r.stderr[-1500:])
