import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    extra = {"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starloom-test-warehouse-"),
             # checkpoints of frames the tests no longer hold are removed promptly
             "spark.cleaner.periodicGC.interval": "1min"}
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="starloom-test-ckpt-")
    session = build_session("local[*]", shuffle_partitions=8, app_name="starloom-tests", extra=extra)
    yield session
    session.stop()
