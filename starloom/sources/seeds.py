"""Seed tables: the returns list and the regional managers.

The returns list is line-grained (one row per returned order line, order ids
repeat), so it is read as a file or derived from the fixture's line table;
it is never inserted row by row.  The managers list is four literal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.staging import fixture_orders
from starloom.sources.tables import LINE_COL, line_salt, literal_rows, read_csv, read_lines, read_table

RETURNS_SCHEMA = T.StructType([
    T.StructField("returned", T.StringType()),
    T.StructField("order_id", T.StringType()),
])

# The flag every returned line carries, and the fixture's line
# status that marks a returned line.
RETURNED_FLAG = "Yes"
FIXTURE_RETURN_STATUS = "R"

# The four regional managers in insertion order (their serial
# keys are 1, 2, 3, 4).  Names as in the source data; the regions are those
# of the fixture's region table (which has a fifth region, MIDDLE EAST, with
# no manager).
MANAGERS = [
    ("Anna Andreadi", "AFRICA"),
    ("Chuck Magee", "AMERICA"),
    ("Kelly Williams", "ASIA"),
    ("Cassandra Brandow", "EUROPE"),
]

def read_returns(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a returns list; ``returned`` and ``order_id`` are bound by name (CSV: by its header)."""
    raw = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return raw.select("returned", "order_id", line_salt(parquet=fmt == "parquet").alias(LINE_COL))


def fixture_returns(spark: SparkSession, root: str) -> DataFrame:
    """One ``('Yes', order_id)`` row per fixture line with return flag 'R'."""
    lines = (read_lines(spark, root, "lineitem", ["l_orderkey", "l_returnflag"])
             .filter(F.col("l_returnflag") == FIXTURE_RETURN_STATUS))
    orders = fixture_orders(spark, root).select("o_orderkey", "order_id")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
            .select(F.lit(RETURNED_FLAG).alias("returned"), "order_id", LINE_COL))


def managers_seed(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """The managers literal with serial keys 1..n in insertion order."""
    rows = MANAGERS if rows is None else rows
    return literal_rows(spark, ["manager_id", "manager", "region"], [(i + 1, m, r) for i, (m, r) in enumerate(rows)])


def managers_by_region(spark: SparkSession, root: str, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every manager, with ``region_known``: whether the region table has the manager's region."""
    regions = read_table(spark, root, "region", ["r_name"]).distinct()
    seed = managers_seed(spark, rows)
    return (seed.join(regions, seed.region == regions.r_name, "left")
            .select("manager_id", "manager", "region", F.col("r_name").isNotNull().alias("region_known")))
