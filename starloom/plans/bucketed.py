"""The fact as a bucketed table, so that updates by order find it where it lies.

``UPDATE sales_fact ... WHERE sf.order_id = ...`` joins the fact with one row per order.  Stored in buckets
of ``order_id``, as are the updates, the two sides meet bucket by bucket: the fact is shuffled once, when
it is written, and by no later update.

A bucket is read by one task, so an order must not outgrow one: the lines of orders with more lines than
an average bucket (fewer orders than there are buckets) are stored apart, in as many files as they need, and meet their
updates, at most one row each, by a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.materialize import stored
from starloom.plans.warehouse import FACT_COLUMNS, Warehouse

ORDER = "order_id"


@dataclass(frozen=True)
class BucketedFact:
    """Names of the three stored tables: the fact in buckets, the lines of hot orders, the updates."""

    fact: str
    hot: str
    updates: str


def _save(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """One file a bucket, sorted by order."""
    (df.repartition(buckets, ORDER).write.format("parquet").option("compression", "zstd").option("path", path)
     .bucketBy(buckets, ORDER).sortBy(ORDER).mode("overwrite").saveAsTable(table))


def hot_orders(fact: DataFrame, rows: int, buckets: int) -> DataFrame:
    """Orders with more than ``rows / buckets`` lines; fewer than ``buckets`` of them exist."""
    return (fact.groupBy(ORDER).agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > rows / buckets).select(ORDER))


def store_fact(w: Warehouse, folder: str, prefix: str, buckets: int) -> BucketedFact:
    """Write the fact and the updates of its orders below ``folder``, as tables named ``<prefix>...``."""
    names = BucketedFact(f"{prefix}_fact", f"{prefix}_hot", f"{prefix}_updates")
    hot = stored(hot_orders(w.sales_fact, w.fact.rows, buckets))
    # a row an order of the hot ones: fewer than buckets
    _save(w.sales_fact.join(F.broadcast(hot), [ORDER], "left_anti"), names.fact, f"{folder}/fact", buckets)
    (w.sales_fact.join(F.broadcast(hot), [ORDER], "left_semi").write.format("parquet").option("compression", "zstd").option("path", f"{folder}/hot")
     .mode("overwrite").saveAsTable(names.hot))
    _save(w.order_updates, names.updates, f"{folder}/updates", buckets)
    return names


def enriched(spark: SparkSession, names: BucketedFact) -> DataFrame:
    """The stored fact with ``return_id`` and ``manager_id``, without an exchange of its lines."""
    updates = spark.table(names.updates)
    columns = [*FACT_COLUMNS, "return_id", "manager_id"]
    usual = spark.table(names.fact).join(updates, [ORDER], "left").select(*columns)
    hot = spark.table(names.hot)
    # at most a row an order of the hot ones
    theirs = updates.join(F.broadcast(hot.select(ORDER).distinct()), [ORDER], "left_semi")
    return usual.unionByName(hot.join(F.broadcast(theirs), [ORDER], "left").select(*columns))
