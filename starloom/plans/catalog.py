"""Registered queries: name -> ``(spark, tables_root) -> DataFrame``.

Every query reads the fixture tables under ``tables_root`` (or frames Spark
derives from them) and runs over them whole.  Each call builds its own
:class:`Warehouse`, so a query pays for exactly the tables it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import audits, refresh
from starloom.plans.contracts import (
    warehouse_fk_violations,
    warehouse_length_violations,
    warehouse_not_null_violations,
    warehouse_numeric_violations,
    warehouse_pk_violations,
)
from starloom.operators.serial_append import append_with_serial
from starloom.plans import bucketed, yearly
from starloom.plans.calendar import calendar_dim
from starloom.plans.warehouse import Warehouse, repair_postal_codes
from starloom.sources.quarantine import read_staging_quarantined
from starloom.sources.seeds import fixture_returns, managers_by_region, managers_seed, read_returns
from starloom.session import ensure_checkpoint_dir
from starloom.sources.staging import STAGING_COLUMNS, fixture_staging, read_staging
from starloom.sources.tables import LINE_COL

Query = Callable[[SparkSession, str], DataFrame]


def _w(spark: SparkSession, root: str, share_staging: bool = True) -> Warehouse:
    return Warehouse.from_fixture(spark, root, share_staging=share_staging)


def _w_with_returns(spark: SparkSession, root: str) -> Warehouse:
    """A warehouse whose fact and returns table are built concurrently."""
    return _w(spark, root).build("fact", "returns")


def _stg_orders(spark, root):
    return fixture_staging(spark, root)


def _geo_completeness_audit(spark, root):
    return audits.geo_completeness_audit(fixture_staging(spark, root))


def _geo_dim_unrepaired(spark, root):
    return _w(spark, root, share_staging=False).geo_unrepaired.df


def _geo_repaired(spark, root):
    return _w(spark, root, share_staging=False).geo_repaired_in_place


def _stg_orders_repaired(spark, root):
    return repair_postal_codes(fixture_staging(spark, root))


def _geo_by_city(spark, root):
    return audits.geo_by_city(_w(spark, root, share_staging=False).geo.df)


def _shipping_dim(spark, root):
    return _w(spark, root, share_staging=False).shipping.df


def _customer_dim(spark, root):
    return _w(spark, root, share_staging=False).customer.df


def _geo_dim(spark, root):
    return _w(spark, root, share_staging=False).geo.df


def _product_dim(spark, root):
    return _w(spark, root, share_staging=False).product.df


def _calendar_dim(spark, root):
    return _w(spark, root, share_staging=False).calendar()


def _sales_fact(spark, root):
    return _w(spark, root).sales_fact


def _sales_fact_unrepaired_count(spark, root):
    return audits.count_rows(_w(spark, root).unrepaired_fact_lines())


def _row_count_reconciliation(spark, root):
    w = _w(spark, root)
    joined = audits.fact_dimension_join(w.sales_fact, w.shipping, w.geo, w.product, w.customer)
    return audits.row_count_reconciliation(w.staging, w.sales_fact, joined)


def _returns_dim(spark, root):
    return _w(spark, root, share_staging=False).returns_dim


# Fixed value: the first order year of the second delivery of returns.
SECOND_DELIVERY_YEAR = "1995"


def _own_folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _deliveries(spark, root):
    """The returns as two deliveries, by order year."""
    returns = fixture_returns(spark, root)
    year = F.substring("order_id", 4, 4)
    return returns.filter(year < SECOND_DELIVERY_YEAR), returns.filter(year >= SECOND_DELIVERY_YEAR)


def _append_returns(spark, path, delivery):
    return append_with_serial(spark, path, delivery, "return_id", ["order_id", "returned"], tiebreak=[LINE_COL]).df


def _returns_append(spark, root):
    """Two deliveries of returns: the second continues the first one's serial keys."""
    path = _own_folder(spark, "returns")
    for delivery in _deliveries(spark, root):
        _append_returns(spark, path, delivery)
    return spark.read.parquet(path).select("return_id", "returned", "order_id")


def _fact_by_year_with_returns(spark, root):
    """The fact by order year, each delivery of returns written into the years it touches."""
    returns, path = _own_folder(spark, "returns"), _own_folder(spark, "fact-by-year")
    yearly.write_by_year(_w(spark, root).sales_fact.withColumn("return_id", F.lit(None).cast("long")), path)
    for delivery in _deliveries(spark, root):
        yearly.apply_returns(spark, path, _append_returns(spark, returns, delivery))
    return spark.read.parquet(path).drop(yearly.YEAR)


def _fact_in_buckets_with_managers(spark, root):
    """The enriched fact from stored buckets."""
    name = f"b{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucketed.enriched(spark, bucketed.store_fact(_w_with_returns(spark, root), _own_folder(spark, "buckets"), name, buckets))


def _returns_from_file(spark, root):
    """The returns list written as the CSV file a user delivers, read and numbered."""
    path = _own_folder(spark, "returns-csv")
    fixture_returns(spark, root).select("order_id", "returned").write.option("header", True).csv(path, compression="gzip")
    return Warehouse(spark, fixture_staging(spark, root), read_returns(spark, path), managers_seed(spark)).returns_dim


def _staging_from_file(spark, root):
    """The staging lines written as a CSV export and read back under the contract."""
    path = _own_folder(spark, "staging-csv")
    fixture_staging(spark, root).write.option("header", True).csv(path, compression="gzip")
    return read_staging(spark, path, fmt="csv")


# The ship modes whose lines the damaged export gives a sales text, a short date, one field too many.
DAMAGED_SALES, DAMAGED_DATE, DAMAGED_WIDTH = "URGENT", "HIGH", "LOW"


def damaged_export(spark: SparkSession, root: str, path: str) -> None:
    """The staging lines as CSV text without a header, those of three ship modes damaged."""
    lines = fixture_staging(spark, root)
    mode, columns = F.col("ship_mode"), lines.columns
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    fields = {c: F.coalesce(quoted(c), F.lit("")) for c in columns}
    fields["sales"] = F.when(mode == DAMAGED_SALES, F.lit("n/a")).otherwise(fields["sales"])
    fields["order_date"] = F.when(mode.isin(DAMAGED_SALES, DAMAGED_DATE), F.lit("1/2")).otherwise(fields["order_date"])
    text = F.concat_ws(",", *[fields[c] for c in columns], F.when(mode == DAMAGED_WIDTH, F.lit("more")))
    lines.select(text.alias("value")).write.text(path, compression="gzip")


def _staging_quarantine(spark, root):
    """A damaged CSV export: how many lines load, and how many are set aside for which reason."""
    path = _own_folder(spark, "damaged-csv")
    damaged_export(spark, root, path)
    read = read_staging_quarantined(spark, path, header=STAGING_COLUMNS)
    return read.good.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("n")).unionByName(read.reasons())


def _load_quality_report(spark, root):
    """The quality report of a full refresh, counted while its tables were written."""
    out = _own_folder(spark, "warehouse")
    refresh.run(_w_with_returns(spark, root), out)
    return refresh.read_quality_report(spark, out)


def _stored_fact(spark, root):
    """The enriched fact after a full refresh: written, checked, published and read back by name."""
    out = _own_folder(spark, "warehouse")
    refresh.run(_w_with_returns(spark, root), out)
    return refresh.read_warehouse(spark, out)["sales_fact"]


def _sales_fact_with_returns(spark, root):
    return _w_with_returns(spark, root).sales_fact_with_returns


def _returns_preview(spark, root):
    return audits.returns_preview(_w_with_returns(spark, root))


def _managers_dim(spark, root):
    return managers_by_region(spark, root)


def _sales_fact_with_managers(spark, root):
    return _w_with_returns(spark, root).sales_fact_with_managers


def _manager_assignment_audit(spark, root):
    return audits.manager_assignment_audit(_w(spark, root))


def _manager_audit_fanout(spark, root):
    # the managers join is many-to-one and keeps the row count, so the count
    # needs only the fact's order ids
    w = _w(spark, root)
    return audits.manager_audit_fanout(w.sales_fact, w.staging)


def _pk_violations(spark, root):
    return warehouse_pk_violations(_w_with_returns(spark, root))


def _not_null_violations(spark, root):
    return warehouse_not_null_violations(_w_with_returns(spark, root))


def _fk_violations(spark, root):
    return warehouse_fk_violations(_w_with_returns(spark, root))


def _length_violations(spark, root):
    return warehouse_length_violations(_w_with_returns(spark, root))


def _numeric_violations(spark, root):
    return warehouse_numeric_violations(_w(spark, root))


def _calendar_fk_gaps(spark, root):
    return audits.calendar_fk_gaps(_w(spark, root).sales_fact, calendar_dim(spark))


QUERIES: dict[str, Query] = {
    "stg_orders": _stg_orders,  # S1
    "geo_completeness_audit": _geo_completeness_audit,  # U1: A5, P7
    "geo_dim_unrepaired": _geo_dim_unrepaired,  # A3, W1
    "geo_repaired": _geo_repaired,  # D1, P8
    "stg_orders_repaired": _stg_orders_repaired,  # D2, P8
    "geo_by_city": _geo_by_city,  # P9, S10
    "shipping_dim": _shipping_dim,  # A1, W1, P2, P6, S7
    "customer_dim": _customer_dim,  # A2, W1, S7
    "geo_dim": _geo_dim,  # A3, W1, D2, S7
    "product_dim": _product_dim,  # A4, W1, P2, S7
    "calendar_dim": _calendar_dim,  # S6, F1-F9, P10
    "sales_fact": _sales_fact,  # J1-J5, F1, W2, S8
    "sales_fact_unrepaired_count": _sales_fact_unrepaired_count,  # J2 NULL keys, A6
    "row_count_reconciliation": _row_count_reconciliation,  # U2: J6, A6
    "returns_dim": _returns_dim,  # S5, S9, W2
    "returns_append": _returns_append,  # S9
    "stored_fact": _stored_fact,  # S2, S7, S8, S11, S12
    "load_quality_report": _load_quality_report,  # Q1-Q5 as observed metrics and key checks of a load
    "fact_in_buckets_with_managers": _fact_in_buckets_with_managers,  # J10, D4 over bucketed S7/S8
    "fact_by_year_with_returns": _fact_by_year_with_returns,  # J9, D3 over partitions, S9
    "returns_from_file": _returns_from_file,  # S5
    "staging_from_file": _staging_from_file,  # S1, P5
    "staging_quarantine": _staging_quarantine,  # S1 with bad records
    "sales_fact_with_returns": _sales_fact_with_returns,  # J9, D3, D5
    "returns_preview": _returns_preview,  # U3: L1
    "managers_dim": _managers_dim,  # S3, S4, S9
    "sales_fact_with_managers": _sales_fact_with_managers,  # J10, D4, D5
    "manager_assignment_audit": _manager_assignment_audit,  # U4: J7, J8, L2, P4
    "manager_audit_fanout": _manager_audit_fanout,  # J8 row count
    "pk_violations": _pk_violations,  # Q1
    "not_null_violations": _not_null_violations,  # Q2
    "fk_violations": _fk_violations,  # Q3
    "length_violations": _length_violations,  # Q4
    "numeric_violations": _numeric_violations,  # Q5
    "calendar_fk_gaps": _calendar_fk_gaps,  # date keys outside the default calendar
}


def main(argv: list[str] | None = None) -> None:
    """``python -m starloom.plans.catalog --query NAME --tables DIR [--out PATH | --show N | --explain]``"""
    import argparse

    from starloom.session import build_session
    parser = argparse.ArgumentParser(description="run one registered query")
    parser.add_argument("--query", required=True, choices=sorted(QUERIES))
    parser.add_argument("--tables", required=True, help="folder with the fixture tables (<name>.parquet)")
    parser.add_argument("--out", default=None, help="write the result here as Parquet (overwrite)")
    parser.add_argument("--show", type=int, default=20, help="rows to print when not writing")
    parser.add_argument("--explain", action="store_true", help="print the formatted physical plan instead")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    df = QUERIES[args.query](spark, args.tables)
    if args.explain:
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
