"""What operators leave in the shared folder."""

import os
import subprocess
import sys

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
from brontide.llm import queries
for name in ("op2_pii", "op5_sharding", "op7_token_counts", "op8_warc", "op13_suffix_dedup"):
    queries.queries()[name](spark, "/root/testdata/sf0.001").count()
spark.stop()
"""


def test_a_session_leaves_cache_and_archives_only(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=root, env=os.environ | {"PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"}, check=True, timeout=600, capture_output=True)
    assert {name.split("-")[0] for name in os.listdir(tmp_path / "brontide")} == {"token", "warc"}
