"""Sinks and files: the full refresh, serial-keyed appends, CSV input."""

import os
import tempfile

from conftest import SF_SMALL
from pyspark.sql import functions as F

from starloom.operators.serial_append import append_with_serial
from starloom.plans.refresh import TABLES, read_warehouse, register_views, run
from starloom.plans.warehouse import Warehouse
from starloom.sources.seeds import RETURNS_SCHEMA, read_returns


def test_full_refresh_writes_every_table(spark):
    out = tempfile.mkdtemp(prefix="starloom-dw-")
    result = run(Warehouse.from_fixture(spark, SF_SMALL), out)
    assert result["reconciliation"] == {"staging_rows": 6000, "fact_rows": 6000, "joined_rows": 6000}
    tables = read_warehouse(spark, out)
    assert set(tables) == set(TABLES)
    assert tables["sales_fact"].count() == 6000
    assert tables["calendar_dim"].count() > 10959
    assert tables["stg_orders"].filter("postal_code is null").count() == 0
    failing = {(v["check"], v["table_name"], v["column_name"]): v["n"] for v in result["violations"]}
    # sales is wider than the declared numeric(9,4) on purpose in the fixture
    assert failing[("numeric", "sales_fact", "sales")] == 282
    assert not [k for k in failing if k[0] in ("primary_key", "foreign_key", "not_null")]

    # SQL over the warehouse tables runs through spark.sql on the registered views
    register_views(tables)
    joined = spark.sql("""
        SELECT count(*) AS n
        FROM sales_fact
        JOIN shipping_dim USING (ship_id) JOIN geo_dim USING (geo_id)
        JOIN product_dim USING (prod_id) JOIN customer_dim USING (cust_id)""").first().n
    assert joined == 6000
    burlington = spark.sql("SELECT * FROM geo_dim WHERE city = 'Burlington'").collect()
    assert burlington and all(r.postal_code is not None for r in burlington)


def test_full_refresh_broadcasts_no_keys_of_unknown_number(spark, monkeypatch):
    """Its checks over the written tables know their rows, whatever the session's threshold."""
    from starloom.plans import audits, refresh
    plans, asked = [], []

    def spied(make):
        def call(*args):
            df = make(*args)
            asked.extend(a.rows for a in args if hasattr(a, "rows"))
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return df
        return call

    monkeypatch.setattr(audits, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(refresh, "fact_dimension_join", spied(refresh.fact_dimension_join))
    monkeypatch.setattr(refresh, "key_checks", lambda tables, make=refresh.key_checks: {k: spied(lambda d: d)(df) for k, df in make(tables).items()})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        out = tempfile.mkdtemp(prefix="starloom-dw-")
        result = run(Warehouse.from_fixture(spark, SF_SMALL), out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert result["reconciliation"] == {"staging_rows": 6000, "fact_rows": 6000, "joined_rows": 6000}
    tables = read_warehouse(spark, out)
    assert asked == [tables[t].count() for t in ("shipping_dim", "geo_dim", "product_dim", "customer_dim")]
    assert len(plans) == 3 and not [p for p in plans if "BroadcastExchange" in p]


def test_append_with_serial_continues_keys(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-append-"), "returns_dim")
    first = spark.createDataFrame([("Yes", "B"), ("Yes", "A")], RETURNS_SCHEMA)
    second = spark.createDataFrame([("Yes", "C"), ("Yes", "A"), ("Yes", "A")], RETURNS_SCHEMA)
    append_with_serial(spark, path, first, "return_id", ["order_id"])
    append_with_serial(spark, path, second, "return_id", ["order_id"])
    rows = sorted(tuple(r) for r in spark.read.parquet(path).select("return_id", "order_id").collect())
    assert rows == [(1, "A"), (2, "B"), (3, "A"), (4, "A"), (5, "C")]


def test_append_restarts_only_where_there_is_no_table(spark):
    """An unreadable table is an error, not an empty one."""
    import pytest
    folder = tempfile.mkdtemp(prefix="starloom-broken-")
    with open(os.path.join(folder, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    rows = spark.createDataFrame([("Yes", "A")], RETURNS_SCHEMA)
    with pytest.raises(Exception):
        append_with_serial(spark, folder, rows, "return_id", ["order_id"])


def test_read_returns_file(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-ret-"), "returns.csv")
    with open(path, "w") as f:
        f.write("returned,order_id\nYes,CA-2016-100762\nYes,CA-2016-100762\nYes,CA-2016-100867\n")
    df = read_returns(spark, path)
    assert df.columns == ["returned", "order_id", "_line"]
    assert df.select("_line").distinct().count() == 3


def test_user_staging_table_end_to_end(spark):
    # a user's own staging export (Parquet, wider types) goes through the same warehouse
    from starloom.sources.seeds import managers_seed
    from starloom.sources.staging import fixture_staging, read_staging
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-stg-"), "stg_orders")
    (fixture_staging(spark, SF_SMALL).withColumn("sales", F.col("sales").cast("decimal(18,4)"))
     .write.parquet(path))
    staging = read_staging(spark, path, keep_line=True)
    assert staging.schema["sales"].dataType.simpleString() == "decimal(11,4)"
    assert staging.select("_line").distinct().count() == 6000
    returns = spark.createDataFrame([("Yes", "CA-1995-000004")], RETURNS_SCHEMA)
    w = Warehouse.from_staging_table(spark, path, returns, managers_seed(spark))
    assert w.staging_base is w.staging_raw   # a stored table is not copied again
    assert w.fact.rows == 6000
    assert w.sales_fact_with_returns.filter("return_id = 1").count() == \
        staging.filter("order_id = 'CA-1995-000004'").count()


def test_full_refresh_publishes_into_a_database(spark):
    out = tempfile.mkdtemp(prefix="starloom-dwdb-")
    run(Warehouse.from_fixture(spark, SF_SMALL), out, database="dw_test")
    assert {t.name for t in spark.catalog.listTables("dw_test")} >= set(TABLES)
    assert spark.table("dw_test.sales_fact").count() == 6000
    assert spark.table("dw_test.shipping_dim").count() == 5
    # a rerun replaces the tables instead of failing on existing ones
    run(Warehouse.from_fixture(spark, SF_SMALL), out, database="dw_test")
    assert spark.table("dw_test.geo_dim").count() == 128


def test_strict_run_raises_with_samples(spark):
    import pytest
    out = tempfile.mkdtemp(prefix="starloom-strict-")
    with pytest.raises(ValueError, match=r"numeric sales_fact.sales \(282 rows\)") as err:
        run(Warehouse.from_fixture(spark, SF_SMALL), out, strict=True)
    # the message carries sample rows of the overflowing sales values
    assert "'sales': Decimal('1" in str(err.value)


def test_failed_load_leaves_the_published_tables(spark):
    """A load whose fact loses lines raises and publishes nothing."""
    import frames
    import pytest
    out = tempfile.mkdtemp(prefix="starloom-safe-")
    good = Warehouse(spark, frames.staging(spark, [{}, {"order_id": "O2"}]), frames.returns(spark, ["O2"]), frames.managers(spark))
    run(good, out)
    before = sorted(map(tuple, read_warehouse(spark, out)["sales_fact"].collect()))
    lossy = Warehouse(spark, frames.staging(spark, [{}, {"customer_name": None}]), frames.returns(spark, []), frames.managers(spark))
    with pytest.raises(ValueError, match="nothing published"):
        run(lossy, out)
    assert sorted(map(tuple, read_warehouse(spark, out)["sales_fact"].collect())) == before
    run(lossy, out, allow_difference=True)
    assert read_warehouse(spark, out)["sales_fact"].count() == 1


def _csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-csvin-"), "in.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_returns_are_bound_by_header(spark):
    import pytest
    rows = read_returns(spark, _csv("order_id,returned\nCA-2016-100762,Yes\n")).collect()
    assert [(r.returned, r.order_id) for r in rows] == [("Yes", "CA-2016-100762")]
    with pytest.raises(Exception):
        read_returns(spark, _csv("id,flag\nCA-2016-100762,Yes\n"))
    with pytest.raises(Exception):
        read_returns(spark, _csv("order_id,returned\nCA-2016-100762\n")).collect()


def test_staging_csv_binds_by_header_and_fails_loudly(spark):
    import frames
    import pytest
    from starloom.sources.staging import STAGING_COLUMNS, read_staging
    values = {c: str(frames.DEFAULTS[c]) for c in STAGING_COLUMNS}
    values["product_name"] = '"a 1.5"" binder, big"'
    order = ["state", "city"] + [c for c in STAGING_COLUMNS if c not in ("state", "city")]

    def read(**changes):
        row = {**values, **changes}
        return read_staging(spark, _csv(",".join(order) + "\n" + ",".join(row[c] for c in order) + "\n"), fmt="csv").collect()

    row = read()[0]
    assert (row.city, row.state, row.product_name) == ("Henderson", "Kentucky", 'a 1.5" binder, big')
    assert (row.sales, row.discount, row.order_date) == (frames.DEFAULTS["sales"], frames.DEFAULTS["discount"], frames.DEFAULTS["order_date"])
    for bad in ({"order_date": "11/08/2016"}, {"sales": "12,5"}, {"quantity": "two"}, {"discount": "x"}):
        with pytest.raises(Exception):
            read(**bad)


def test_read_returns_parquet(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-retpq-"), "returns")
    spark.createDataFrame([("Yes", "CA-2016-100762"), ("Yes", "CA-2016-100762")], RETURNS_SCHEMA) \
        .write.parquet(path)
    df = read_returns(spark, path, fmt="parquet")
    assert df.columns == ["returned", "order_id", "_line"]
    assert df.count() == 2 and df.select("_line").distinct().count() == 2


def test_csv_staging_gives_the_same_fact(spark):
    from starloom.sources.seeds import managers_seed
    from starloom.sources.staging import fixture_staging
    root = tempfile.mkdtemp(prefix="starloom-csv-")
    fixture_staging(spark, SF_SMALL).write.option("header", True).csv(os.path.join(root, "stg_csv"))
    fixture_staging(spark, SF_SMALL).write.parquet(os.path.join(root, "stg_pq"))
    returns = spark.createDataFrame([("Yes", "CA-1995-000004")], RETURNS_SCHEMA)
    facts = []
    for fmt, folder in (("csv", "stg_csv"), ("parquet", "stg_pq")):
        w = Warehouse.from_staging_table(spark, os.path.join(root, folder), returns, managers_seed(spark), fmt=fmt)
        facts.append(sorted(tuple(r) for r in w.sales_fact_with_managers.collect()))
    assert len(facts[0]) == 6000
    assert facts[0] == facts[1]
