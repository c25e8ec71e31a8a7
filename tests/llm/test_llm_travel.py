"""Operators on workers that have no copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from inkspan.llm.queries import QUERIES
from inkspan.session import local_session
from pyspark.sql import functions as F

spark = local_session(4, "travel", **{"spark.sql.shuffle.partitions": "4"})

@F.udf("boolean")
def has_package(_):
    import importlib.util
    return importlib.util.find_spec("inkspan") is not None

assert not spark.range(1).select(has_package("id")).first()[0]
for name, query in QUERIES.items():
    if name.split("_")[0] in ("op2", "op3", "op5", "op6", "op7", "op8", "op9", "op11", "op12", "op13"):
        query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


def test_operators_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = str(Path(__file__).resolve().parents[2])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 10
