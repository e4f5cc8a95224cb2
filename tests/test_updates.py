"""Conditional updates, the update-from rule, and the postal-code repair."""

from pyspark.sql import functions as F

from starloom.operators.updates import conditional_update, update_from
from starloom.plans.warehouse import repair_postal_codes


def test_targeted_repair(spark):
    geo = spark.createDataFrame(
        [("United States", "Burlington", "Vermont", None),
         ("United States", "Burlington", "Iowa", "05001"),
         ("United States", "Other", "Vermont", None)],
        "country string, city string, state string, postal_code string")
    got = sorted(tuple(r) for r in repair_postal_codes(geo).collect())
    assert got == sorted([("United States", "Burlington", "Vermont", "05401"),
                          ("United States", "Burlington", "Iowa", "05001"),
                          ("United States", "Other", "Vermont", None)])


def test_conditional_update_keeps_rows_and_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    out = conditional_update(df, {"v": "z"}, F.col("v").isNull())
    assert out.columns == ["id", "v"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "z"), (3, "c")]


def test_update_from_many_matches_takes_lowest(spark):
    fact = spark.createDataFrame([(1, "O1"), (2, "O1"), (3, "O2"), (4, None)],
                                 "sales_id bigint, order_id string")
    ret = spark.createDataFrame([(7, "O1"), (5, "O1"), (9, "O1")], "return_id bigint, order_id string")
    out = update_from(fact, ret, ["order_id"], {"return_id": "return_id"})
    assert out.columns == ["sales_id", "order_id", "return_id"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "O1", 5), (2, "O1", 5), (3, "O2", None),
                                                       (4, None, None)]


def test_update_from_keeps_old_value_when_unmatched(spark):
    fact = spark.createDataFrame([(1, "O1", 10), (2, "O2", 20)], "sales_id bigint, order_id string, m bigint")
    src = spark.createDataFrame([(3, "O1")], "m bigint, order_id string")
    out = update_from(fact, src, ["order_id"], {"m": "m"})
    assert out.columns == ["sales_id", "order_id", "m"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "O1", 3), (2, "O2", 20)]


def test_update_from_max_rule(spark):
    fact = spark.createDataFrame([(1, "O1")], "sales_id bigint, order_id string")
    src = spark.createDataFrame([(7, "O1"), (9, "O1")], "return_id bigint, order_id string")
    out = update_from(fact, src, ["order_id"], {"return_id": "return_id"}, tie="max")
    assert [tuple(r) for r in out.collect()] == [(1, "O1", 9)]


def test_update_from_takes_all_values_from_one_row(spark):
    fact = spark.createDataFrame([(1, "O1")], "sales_id bigint, order_id string")
    src = spark.createDataFrame([("O1", 1, "z"), ("O1", 2, "a"), ("O1", None, "b")], "order_id string, x bigint, y string")
    for tie, expect in (("min", (1, "z")), ("max", (2, "a"))):
        row = update_from(fact, src, ["order_id"], {"a": "x", "b": "y"}, tie=tie).first()
        assert (row.a, row.b) == expect


def test_hot_key_of_an_update_is_split(spark):
    """No output partition of the update holds the whole of a key with most rows."""
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = 60_000
        fact = spark.range(0, 90_000, numPartitions=8).select(
            F.md5(F.col("id").cast("string")).alias("line"),  # does not compress: sizes count compressed bytes
            F.when(F.col("id") < hot, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_id"))
        src = spark.range(0, 1000).select(F.col("id").alias("return_id"), F.when(F.col("id") < 3, F.lit("HOT"))
                                          .otherwise((F.col("id") + hot).cast("string")).alias("order_id"))
        out = update_from(fact, src, ["order_id"], {"return_id": "return_id"})
        of_hot = F.sum((F.col("order_id") == "HOT").cast("int")).alias("n")
        parts = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(of_hot, F.max("line")).collect()]
        assert sum(parts) == hot and max(parts) < hot
        assert out.filter("return_id = 0").count() == hot
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_zero_pad_matches_printf(spark):
    from starloom.sources.tables import zero_pad
    values = [0, 5, 42, 123456, 1234567, -5, -123456]
    got = [r.p for r in spark.createDataFrame([(v,) for v in values], "v bigint")
           .select(zero_pad(F.col("v"), 6).alias("p")).collect()]
    assert got == ["%06d" % v for v in values]
