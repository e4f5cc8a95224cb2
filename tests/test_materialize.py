"""Steps that are written for good leave no shuffle files behind."""

import os
import subprocess
import sys

from starloom.operators.materialize import REMOVE_SHUFFLES, shuffles_removed

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# a session of its own, whose executors' folder is known
SCRIPT = """
import glob, sys, time
from pyspark.sql import functions as F
from starloom.operators.materialize import materialize, stored
from starloom.session import build_session

top = sys.argv[1]
spark = build_session("local[2]", 2, extra={"spark.local.dir": f"{top}/local", "spark.checkpoint.dir": f"{top}/kept"})
files = lambda: glob.glob(f"{top}/local/**/shuffle_*", recursive=True)
made = [spark.range(1000).groupBy((F.col("id") % (7 + i)).alias("k")).count() for i in range(3)]
kept = [materialize(made[0]), stored(made[1]), stored(made[2], "zstd")]
until = time.time() + 10
while files() and time.time() < until:
    time.sleep(0.2)
assert not files(), files()
for i, rows in enumerate(kept):
    assert sorted(tuple(r) for r in rows.collect()) == sorted(tuple(r) for r in made[i].collect())
    assert rows.count() == 7 + i
assert files()
"""


def test_written_steps_leave_no_shuffle_files(tmp_path):
    env = {**os.environ, "PYTHONPATH": ROOT}
    env.pop("SPARK_LOCAL_DIRS", None)
    ran = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]


def test_the_session_keeps_its_own_setting(spark):
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    with shuffles_removed(spark):
        assert spark.conf.get(REMOVE_SHUFFLES) == "true"
    assert spark.conf.get(REMOVE_SHUFFLES, None) == before
