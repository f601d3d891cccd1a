"""Python workers find the package from any working directory."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from jobweave.queries import QUERIES
from jobweave.session import build_session, clean_up, shared_folder
spark = build_session("workers", "local[2]", **{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g", "spark.checkpoint.dir": "file://" + sys.argv[3]})
sys.path.remove(sys.argv[1])
for name in ("extract_listing_rows", "extract_metadata", "vector_shortlist", "backfill_match"):
    assert QUERIES[name](spark, sys.argv[2]).count() > 0, name
from jobweave.session import materialize
materialize(spark.range(3), "left")
import os
here = os.path.join(sys.argv[3], "jobweave")
assert os.listdir(here)
clean_up(spark)
assert not os.listdir(here)
spark.stop()
"""


def test_queries_with_python_in_another_folder(data, tmp_path):
    shared = tmp_path / "shared"
    shared.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, data, str(shared)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
