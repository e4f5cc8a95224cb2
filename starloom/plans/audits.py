"""Audit queries over the warehouse: completeness, reconciliation, previews.

None of them emits all pairs of a fan-out join.  Where an audit is defined
over a many-to-many join (fact lines x staging lines of the same order), the
staging side is first reduced to counts per key and the result is computed
from those counts, so an order with many lines costs one row, not its square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.dense_ids import Numbered
from starloom.operators.materialize import stored
from starloom.operators.updates import update_from
from starloom.plans.warehouse import BROADCAST_ROWS, GAP_CITY, Warehouse


def geo_completeness_audit(staging: DataFrame) -> DataFrame:
    """Distinct geographies with a missing country, city or postal code.

    The filter runs before the distinct (same rows as filtering the distinct
    dimension), so it is pushed to the scan and only gap rows are shuffled.
    ``state`` is deliberately not tested.
    """
    gap = F.col("country").isNull() | F.col("city").isNull() | F.col("postal_code").isNull()
    return staging.filter(gap).select("country", "city", "state", "postal_code").distinct()


def geo_by_city(geo_dim: DataFrame, city: str = GAP_CITY) -> DataFrame:
    return geo_dim.filter(F.col("city") == city)


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def fact_dimension_keys(fact: DataFrame, shipping: DataFrame, geo: DataFrame, product: DataFrame, customer: DataFrame) -> DataFrame:
    """The fact's lines that find their row in all four dimensions, by surrogate key."""
    fact = fact.select("ship_id", "geo_id", "prod_id", "cust_id")
    for dim, key in ((shipping, "ship_id"), (geo, "geo_id"), (product, "prod_id"), (customer, "cust_id")):
        fact = fact.join(dim.select(key), [key], "inner")
    return fact


def fact_dimension_join(fact: DataFrame, shipping: Numbered, geo: Numbered, product: Numbered,
                        customer: Numbered) -> DataFrame:
    """The fact joined back to the four dimensions by surrogate key.  The small ones are broadcast, the others joined by a sort:
    the row count is known, no broadcast follows from a guess of the bytes."""
    sides = [F.broadcast(dim.df) if dim.rows <= BROADCAST_ROWS else dim.df.hint("merge") for dim in (shipping, geo, product, customer)]
    return fact_dimension_keys(fact, *sides)


def row_count_reconciliation(staging: DataFrame, fact: DataFrame, joined: DataFrame) -> DataFrame:
    """One row: staging lines, fact lines, fact lines that resolve all four dimensions.

    The three counts come from one job: the three inputs are tagged and
    unioned, then summed with a single global aggregate.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    tags = ["staging_rows", "fact_rows", "joined_rows"]

    def tagged(df: DataFrame, which: str) -> DataFrame:
        return df.select(*[(one if t == which else zero).alias(t) for t in tags])

    parts = (tagged(staging, "staging_rows")
             .unionByName(tagged(fact, "fact_rows"))
             .unionByName(tagged(joined, "joined_rows")))
    return parts.agg(*[F.sum(t).cast("long").alias(t) for t in tags]) \
        .select(*[F.coalesce(F.col(t), F.lit(0).cast("long")).alias(t) for t in tags])


def first_fact_lines(w: Warehouse, k: int) -> DataFrame:
    """The ``k`` fact lines with the smallest ``sales_id``: a top-k (each task
    keeps its best ``k``, one merge), no sort or shuffle of the whole fact."""
    return w.sales_fact.orderBy("sales_id").limit(k)


def returns_preview(w: Warehouse, k: int = 10) -> DataFrame:
    """The first ``k`` lines of the fact with returns, by ``sales_id``.

    ``return_id`` depends only on a line's order, so the top ``k`` lines are
    taken first and only they are enriched, from the returns of their orders; the result
    equals the top ``k`` of the enriched fact.
    """
    top = stored(first_fact_lines(w, k))
    returns = w.returns_dim.join(top.select("order_id").distinct(), ["order_id"], "left_semi")
    return update_from(top, returns, ["order_id"], {"return_id": "return_id"}).orderBy("sales_id")


AUDIT_COLUMNS = ["sales_id", "order_id", "manager_id", "manager_name", "manager_region", "order_region"]


def manager_assignment_audit(w: Warehouse, k: int = 20) -> DataFrame:
    """First ``k`` rows, by ``(sales_id, order_region)``, of

        fact LEFT JOIN managers ON manager_id LEFT JOIN staging ON order_id

    computed without the fan-out.  Each fact line stands for ``copies``
    identical output rows per order region (``copies`` = staging lines of the
    order in that region; one NULL-region row when the order has none).  The
    ``k`` smallest (sales_id, region) groups hold the first ``k`` rows, since
    every group has at least one row; each of those is expanded to at most
    ``k`` copies, which is exact because no more than ``k`` rows are kept.

    Those groups belong to the ``k`` lines with the smallest ``sales_id``.  They are taken once
    and written; one scan of two staging columns then gives the copies per region of their orders,
    and from these regions follow the orders' managers.
    """
    top = stored(first_fact_lines(w, k).select("sales_id", "order_id"))
    regions = stored(w.staging.select("order_id", F.col("region").alias("order_region"))
                     .join(top.select("order_id").distinct(), ["order_id"], "left_semi")
                     .groupBy("order_id", "order_region").agg(F.count(F.lit(1)).alias("copies")))
    managers = w.managers_dim.select("manager_id", F.col("manager").alias("manager_name"), F.col("region").alias("manager_region"))
    assigned = (regions.join(managers, regions.order_region == managers.manager_region, "inner")
                .groupBy("order_id").agg(F.min("manager_id").alias("manager_id")))
    groups = (top.join(assigned, ["order_id"], "left").join(managers, ["manager_id"], "left")
              .join(regions, ["order_id"], "left")
              .select(*AUDIT_COLUMNS, F.coalesce(F.col("copies"), F.lit(1)).alias("copies")))
    order = [F.col("sales_id").asc(), F.col("order_region").asc_nulls_first()]
    first_groups = groups.orderBy(*order).limit(k)
    expanded = first_groups.select(
        *AUDIT_COLUMNS,
        F.explode(F.array_repeat(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))).alias("_copy"))
    return expanded.orderBy(*order).limit(k).select(*AUDIT_COLUMNS)


def manager_audit_fanout(fact: DataFrame, staging: DataFrame) -> DataFrame:
    """Row count of the audit join before its LIMIT: each fact line counts
    the staging lines of its order (1 when there are none).  Both sides are
    reduced to counts per order first; no pair is emitted."""
    lines = staging.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))
    per_order = fact.groupBy("order_id").agg(F.count(F.lit(1)).alias("fact_lines"))
    joined = per_order.join(lines, ["order_id"], "left")
    total = F.sum(F.col("fact_lines") * F.coalesce(F.col("lines"), F.lit(1)))
    return joined.agg(F.coalesce(total, F.lit(0)).cast("long").alias("n"))


def calendar_fk_gaps(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Date keys of the fact (order and ship dates) absent from ``calendar``,
    with their number of uses.  Keys are counted first (combined map-side),
    then anti-joined to the calendar."""
    keys = (fact.select(F.col("order_date_id").alias("date_id"))
            .unionByName(fact.select(F.col("ship_date_id").alias("date_id"))))
    counted = keys.groupBy("date_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(calendar.select(F.col("dateid").alias("date_id")), ["date_id"], "left_anti")
