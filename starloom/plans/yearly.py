"""The fact partitioned by order year, and returns applied to the years they touch.

New returns update the lines of their orders.  The fact is stored in one partition an order year; a delivery of
returns reads the partitions that hold its orders, and writes these back with *dynamic partition overwrite*: all other
partitions keep their files.  A line's ``return_id`` stays the lowest key of its order's returns, over all deliveries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.materialize import stored

YEAR = "order_year"


def write_by_year(fact: DataFrame, path: str) -> None:
    """Store ``fact`` in partitions by the year of ``order_date_id``.

    Lines are dealt out by year and a hash of the line, in as many parts as the session shuffles to, so a year that
    holds most lines is written by many tasks.
    """
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (fact.withColumn(YEAR, F.floor(F.col("order_date_id") / 10_000).cast("int"))
     .repartition(YEAR, F.pmod(F.xxhash64("sales_id"), F.lit(parts)))
     .sortWithinPartitions(YEAR, "order_id", "sales_id").write.partitionBy(YEAR).parquet(path, compression="zstd"))


def touched_years(spark: SparkSession, path: str, returns: DataFrame) -> list[int]:
    """The partitions with lines of returned orders; one number a year reaches the driver."""
    keys = returns.select("order_id").distinct()
    years = spark.read.parquet(path).select("order_id", YEAR).join(keys, ["order_id"], "left_semi").select(YEAR).distinct()
    return sorted(r[YEAR] for r in years.collect())


def apply_returns(spark: SparkSession, path: str, returns: DataFrame) -> list[int]:
    """Set ``return_id`` of the lines of ``returns`` (return_id, order_id); returns the rewritten years."""
    lowest = stored(returns.groupBy("order_id").agg(F.min("return_id").alias("_return_id")), "zstd")
    years = touched_years(spark, path, lowest)
    if years:
        fact = spark.read.parquet(path).filter(F.col(YEAR).isin(years))
        updated = (fact.join(lowest, ["order_id"], "left")
                   .withColumn("return_id", F.least("return_id", "_return_id")).select(*fact.columns))
        # written aside first: the partitions that are replaced are those that are read
        (stored(updated, "zstd").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path, compression="zstd"))
    return years
