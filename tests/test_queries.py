"""Every registered query against its SQL twin in DuckDB, and golden counts."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from oracle_compare import compare, duckdb_connection

import __spark_entry__ as entry_module
from starloom.plans.catalog import QUERIES as WAREHOUSE_QUERIES

QUERIES = {name: fn for name, fn in entry_module.queries().items() if name in WAREHOUSE_QUERIES}
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in WAREHOUSE_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = compare(QUERIES[name](spark, SF_SMALL), duck, ORACLE[name])
    assert result["ok"], result


# Golden counts (FIXTURES.md section 4): staging, distinct orders, dimension sizes, NULL postal
# codes, Burlington lines, returns rows / orders, lines with a return, lines without a manager,
# audit join rows before the LIMIT, sales over numeric(9,4), dates before the calendar.
GOLDEN = {
    "/root/testdata/sf0.001": (6000, 1473, (5, 150, 128, 997), 41, 373, (1968, 1096), 4890, 1319, 30016, 282, 1740),
    "/root/testdata/sf0.1": (600000, 147236, (5, 14999, 500, 99765), 1150, 29883, (200025, 110598), 495079,
                             117717, 2999846, 28806, 1826),
}


@pytest.mark.parametrize("sf_dir", sorted(GOLDEN))
def test_golden_counts(spark, sf_dir):
    from starloom.plans import audits
    from starloom.plans.warehouse import Warehouse
    (stg, orders, dims, null_codes, burlington, returns, with_return, no_manager, fanout, overflow,
     early_dates) = GOLDEN[sf_dir]
    w = Warehouse.from_fixture(spark, sf_dir)
    assert w.staging_base.count() == stg
    assert w.staging.select("order_id").distinct().count() == orders
    assert (w.shipping.rows, w.customer.rows, w.geo.rows, w.product.rows) == dims
    assert w.staging_base.filter("postal_code is null").count() == null_codes
    assert w.staging.filter("city = 'Burlington'").count() == burlington
    assert (w.returns.rows, w.returns_dim.select("order_id").distinct().count()) == returns
    enriched = w.sales_fact_with_managers
    assert enriched.filter("return_id is not null").count() == with_return
    assert enriched.filter("manager_id is null").count() == no_manager
    assert w.fact.rows == stg
    assert audits.manager_audit_fanout(w.sales_fact, w.staging).first().n == fanout
    assert w.sales_fact.filter("sales > 99999.9999").count() == overflow
    early = (w.sales_fact.select(F.col("order_date_id").alias("d"))
             .union(w.sales_fact.select(F.col("ship_date_id").alias("d")))
             .filter("d < 20000101").distinct().count())
    assert early == early_dates


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() == 6000
    assert df.columns[-2:] == ["return_id", "manager_id"]


@pytest.mark.parametrize("name", ["sales_fact", "sales_fact_with_managers", "calendar_fk_gaps", "manager_assignment_audit"])
def test_shuffle_joins_match_oracle(spark, duck, name):
    # large dimensions are joined by shuffles; force that on the small fixture
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        result = compare(QUERIES[name](spark, SF_SMALL), duck, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    assert result["ok"], result
