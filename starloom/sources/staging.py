"""The staging table ``stg_orders``: one row per retail order line.

Two ways in:

* :func:`read_staging` reads a staging table that already has the 20 columns
  (a user's own export) and enforces the column contract;
* :func:`fixture_staging` derives the same 20 columns from the TPC-H-like
  fixture tables (lineitem, orders, customer, nation, region, part), so the
  whole job can run on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.tables import LINE_COL, line_salt, read_csv, read_lines, read_table, zero_pad

# Measures are staged wider than the fact declares them, so that a value that does not fit
# arrives and is reported by the numeric check.
STAGING_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("ship_date", T.DateType()),
    T.StructField("ship_mode", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("sales", T.DecimalType(11, 4)),
    T.StructField("profit", T.DecimalType(25, 16)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DecimalType(8, 2)),
])

STAGING_COLUMNS = [f.name for f in STAGING_SCHEMA.fields]

# Fixed values of the fixture adapter: the country every line is sold in, the
# city whose lines may lack a postal code (customers with
# c_custkey % 20 = 7), the nation whose Burlington customers have no postal
# code, and the profit margin before discount.
FIXTURE_COUNTRY = "United States"
FIXTURE_GAP_CITY = "Burlington"
FIXTURE_GAP_CITY_BUCKET = 7
FIXTURE_GAP_NATION = 5
FIXTURE_MARGIN = "0.20"
# Nations of at most so many rows, by their exact count, join the lines after the shuffles.
FEW_NATIONS = 10_000


def conform_staging(df: DataFrame, keep_line: bool = False) -> DataFrame:
    """Project and cast to the staging contract, binding columns by name.

    A text that is not a value of its column's type fails, whatever the session's ANSI setting.
    """
    def bound(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType):
            value = F.col(f.name).try_cast(f.dataType)
            bad = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(f.name))
            value = F.when(F.col(f.name).isNotNull() & value.isNull(), F.raise_error(bad).cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    cols = [bound(f) for f in STAGING_SCHEMA.fields]
    if keep_line:
        cols.append(F.col(LINE_COL))
    return df.select(*cols)


def read_staging(spark: SparkSession, path: str, keep_line: bool = False, fmt: str = "parquet") -> DataFrame:
    """Read an existing staging table under the column contract.

    Columns are bound by name, from the Parquet schema or the CSV header, and
    cast; types are never inferred.  CSV dates are ``yyyy-MM-dd``.  A missing column, a
    record of another width or a malformed value fails.
    """
    if fmt == "csv":
        raw = read_csv(spark, path)
    else:
        raw = spark.read.format(fmt).load(path)
    if keep_line:
        raw = raw.withColumn(LINE_COL, line_salt(parquet=fmt == "parquet"))
    return conform_staging(raw, keep_line)


def _nations(spark: SparkSession, root: str) -> DataFrame:
    nation = read_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, root, "region", ["r_regionkey", "r_name"])
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
            .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"))


def _customer_columns() -> list[Column]:
    """The staging attributes of a customer, from its columns and those of :func:`_nations`."""
    bucket = F.col("c_custkey") % 20
    gap = (bucket == FIXTURE_GAP_CITY_BUCKET) & (F.col("c_nationkey") == FIXTURE_GAP_NATION)
    return [
        F.concat(F.lit("C"), zero_pad(F.col("c_custkey"), 7)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(FIXTURE_COUNTRY).alias("country"),
        F.when(bucket == FIXTURE_GAP_CITY_BUCKET, F.lit(FIXTURE_GAP_CITY))
         .otherwise(F.concat(F.lit("City_"), bucket.cast("string"))).alias("city"),
        F.col("n_name").alias("state"),
        F.when(gap, F.lit(None).cast("string"))
         .otherwise(zero_pad(F.col("c_nationkey") * 100 + bucket, 5)).alias("postal_code"),
        F.col("r_name").alias("region"),
    ]


def fixture_orders(spark: SparkSession, root: str) -> DataFrame:
    """Order-level columns: the order id text, dates and ship mode."""
    return _order_rows(spark, root).select("o_orderkey", "o_custkey", *_order_columns())


def _order_rows(spark: SparkSession, root: str) -> DataFrame:
    orders = read_table(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _order_columns() -> list[Column]:
    """The staging attributes of an order, from the columns of :func:`_order_rows`."""
    return [
        order_id_expr(F.col("o_orderdate"), F.col("o_orderkey")).alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.substr(F.col("o_orderpriority"), F.lit(3)).alias("ship_mode"),
    ]


def order_id_expr(order_ts, order_key):
    """``CA-<year>-<key padded to 6 digits>``; longer keys keep all digits."""
    return F.concat(F.lit("CA-"), F.year(order_ts).cast("string"), F.lit("-"),
                    zero_pad(order_key, 6))


def fixture_dates(spark: SparkSession, root: str) -> DataFrame:
    """Every order and ship date of the fixture, as ``date``: two narrow scans, no join."""
    ordered = read_table(spark, root, "orders", ["o_orderdate"]).select(F.col("o_orderdate").cast("date").alias("date"))
    shipped = read_table(spark, root, "lineitem", ["l_shipdate"]).select(F.col("l_shipdate").cast("date").alias("date"))
    return ordered.unionByName(shipped)


def fixture_staging(spark: SparkSession, root: str, keep_line: bool = False, by_product: bool = False) -> DataFrame:
    """Derive ``stg_orders`` from the fixture tables; one row per lineitem.

    Plan shape: customers are joined to orders first, so the line-sized side is
    shuffled once on the order key and once on the part key.  Measures are cast before the shuffles, and
    texts that follow from keys are made after them; so are the names of nation and region, which
    are broadcast once their count shows them to be few.  No other join side is hinted: adaptive execution
    measures each side and broadcasts it only when it proves small (at small scale customers and parts);
    everything larger stays a shuffle join.  Measuring needs no extra job, which an up-front row
    count per side would.

    With ``by_product`` the parts are joined by the product id, which tells part keys apart, so that lines which meet them by a
    shuffle lie by product id.
    """
    lines = read_lines(spark, root, "lineitem", ["l_orderkey", "l_partkey", "l_quantity",
                                                  "l_extendedprice", "l_discount", "l_shipdate"], keep_line)
    sales, discount = T.DecimalType(11, 4), T.DecimalType(8, 2)
    lines = lines.select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"),
                         F.col("l_extendedprice").cast(sales).alias("sales"), F.col("l_quantity").cast("int").alias("quantity"),
                         F.col("l_discount").cast(discount).alias("discount"), *([LINE_COL] if keep_line else []))
    part = read_table(spark, root, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    product_id = lambda key: F.concat(F.lit("P-"), zero_pad(F.col(key), 8))
    orders = _order_rows(spark, root)
    customer = read_table(spark, root, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    nations = _nations(spark, root)
    few = nations.count() <= FEW_NATIONS
    if not few:
        customer = customer.join(nations, ["c_nationkey"], "inner")
    order_rows = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").drop("o_custkey")
    ordered = lines.join(order_rows, lines.l_orderkey == order_rows.o_orderkey, "inner").drop("l_orderkey")
    if by_product:
        ordered = ordered.withColumn("product_id", product_id("l_partkey")).drop("l_partkey")
        joined = ordered.join(part.withColumn("product_id", product_id("p_partkey")).drop("p_partkey"), "product_id", "inner")
    else:
        joined = ordered.join(part, ordered.l_partkey == part.p_partkey, "inner").withColumn("product_id", product_id("p_partkey"))
    if few:
        joined = joined.join(F.broadcast(nations), ["c_nationkey"], "inner")
    margin = F.lit(FIXTURE_MARGIN).cast(T.DecimalType(4, 2))
    staged = joined.select(
        *_order_columns(), "ship_date", *_customer_columns(),
        "product_id",
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        "sales",
        (F.col("sales") * (margin - F.col("discount"))).cast(T.DecimalType(25, 16)).alias("profit"),
        "quantity", "discount",
        *([LINE_COL] if keep_line else []),
    )
    return conform_staging(staged, keep_line)
