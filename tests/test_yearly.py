"""Returns rewrite the years they touch and no other."""

import os
import tempfile

from pyspark.sql import functions as F

from starloom.plans import yearly

FACT = [(1, 20150101, "A"), (2, 20150203, "A"), (3, 20160101, "B"), (4, 20160707, "C"), (5, 20170101, "D"), (6, 20170101, None)]


def _files(path, year):
    folder = os.path.join(path, f"order_year={year}")
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))


def _stored(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-years-"), "fact")
    fact = spark.createDataFrame(FACT, "sales_id bigint, order_date_id int, order_id string").withColumn("return_id", F.lit(None).cast("long"))
    yearly.write_by_year(fact, path)
    return path


def _returned(spark, path):
    return {r.sales_id: r.return_id for r in spark.read.parquet(path).collect()}


def test_untouched_years_keep_their_files(spark):
    path = _stored(spark)
    before = {y: _files(path, y) for y in (2015, 2016, 2017)}
    assert all(before.values())
    touched = yearly.apply_returns(spark, path, spark.createDataFrame([(9, "B"), (8, "B"), (7, "nowhere"), (6, None)], "return_id bigint, order_id string"))
    assert touched == [2016]
    assert _returned(spark, path) == {1: None, 2: None, 3: 8, 4: None, 5: None, 6: None}
    after = {y: _files(path, y) for y in (2015, 2016, 2017)}
    assert after[2015] == before[2015] and after[2017] == before[2017] and after[2016] != before[2016]


def test_lowest_key_stays_over_deliveries(spark):
    path = _stored(spark)
    for keys in ([(5, "A"), (6, "D")], [(3, "A"), (9, "D")], [(4, "A")], []):
        yearly.apply_returns(spark, path, spark.createDataFrame(keys, "return_id bigint, order_id string"))
    assert _returned(spark, path) == {1: 3, 2: 3, 3: None, 4: None, 5: 6, 6: None}
