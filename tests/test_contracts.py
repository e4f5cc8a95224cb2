"""Constraint checks: keys, NOT NULL, varchar lengths, numeric ranges, foreign keys."""

from decimal import Decimal

from starloom.operators.contracts import (
    ColumnContract as C,
    TableContract,
    dense_pk_violations,
    violating_rows,
    fk_violations,
    length_violations,
    not_null_violations,
    numeric_violations,
    pk_violations,
    write_observed,
)

CONTRACT = TableContract("t", "id", (
    C("id"), C("mode", max_length=14), C("cust", max_length=8),
    C("sales", decimal=(9, 4)), C("discount", decimal=(4, 2)), C("note", nullable=True)))


def _frame(spark):
    rows = [
        (1, "Standard Class", "C0000001", Decimal("99999.9999"), Decimal("0.10"), None),
        (2, "Standard Classes", None, Decimal("100000.0000"), Decimal("100.00"), "x"),   # 16 chars, NULL, two overflows
        (2, "First", "C0000003", Decimal("1.0000"), Decimal("0.00"), None),              # duplicate key
        (None, "First", "C0000004", Decimal("1.0000"), Decimal("0.00"), None),           # NULL key
    ]
    return spark.createDataFrame(rows, "id bigint, mode string, cust string, sales decimal(11,4), "
                                       "discount decimal(6,2), note string")


def _as_dict(df):
    return {(r.table_name, r.column_name): r.n for r in df.collect()}


def test_pk(spark):
    assert _as_dict(pk_violations([(_frame(spark), CONTRACT)])) == {("t", "id"): 3}


def test_not_null(spark):
    got = _as_dict(not_null_violations([(_frame(spark), CONTRACT)]))
    assert got == {("t", "id"): 1, ("t", "mode"): 0, ("t", "cust"): 1, ("t", "sales"): 0, ("t", "discount"): 0}


def test_length(spark):
    assert _as_dict(length_violations([(_frame(spark), CONTRACT)])) == {("t", "mode"): 1, ("t", "cust"): 0}


def test_numeric(spark):
    assert _as_dict(numeric_violations([(_frame(spark), CONTRACT)])) == {("t", "sales"): 1, ("t", "discount"): 1}


def test_fk(spark):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None), (4, 5)], "sales_id bigint, manager_id bigint")
    parent = spark.createDataFrame([(1, "Anna Andreadi"), (2, "Chuck Magee")], "manager_id bigint, manager string")
    report = fk_violations(child, "sales_fact", "manager_id", parent, "manager_id")
    assert _as_dict(report) == {("sales_fact", "manager_id"): 2}


def test_fk_broadcasts_no_keys(spark):
    """Whatever the session's threshold: stored keys look small to the planner by their compressed bytes.  Repeated and NULL keys
    on both sides, keys of another type, an empty side."""
    from pyspark.sql import functions as F

    from starloom.operators.materialize import stored
    child = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 2, 7, 7, 7, 8, None, None])], "sales_id bigint, return_id int")
    parent = stored(spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "return_id bigint"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        found = {}
        for name, uses, keys in (("both", child, parent), ("no keys", child, parent.limit(0)), ("no uses", child.limit(0), parent)):
            report = fk_violations(uses, "sales_fact", "return_id", keys, "return_id")
            found[name] = _as_dict(report)[("sales_fact", "return_id")]
            plan = report._jdf.queryExecution().executedPlan().toString()
            assert "Broadcast" not in plan, plan
        contract = TableContract("sales_fact", "return_id", (C("return_id"),))
        for check, ids in (("foreign_key", [3, 4, 5, 6]), ("primary_key", [0, 1, 3, 4, 5, 7, 8])):
            rows = violating_rows(child, contract, check, "return_id", parent, "return_id")
            assert sorted(r.sales_id for r in rows.collect()) == ids
            assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {"both": 4, "no keys": 7, "no uses": 0}


def test_violating_rows(spark):
    df = _frame(spark)
    ids = lambda check, col: sorted((r.id for r in violating_rows(df, CONTRACT, check, col).collect()),
                                    key=lambda v: (v is not None, v))
    assert ids("not_null", "cust") == [2]
    assert ids("length", "mode") == [2]
    assert ids("numeric", "sales") == [2]
    assert ids("primary_key", "id") == [None, 2, 2]
    parent = spark.createDataFrame([(1,)], "pid bigint")
    orphans = violating_rows(df, CONTRACT, "foreign_key", "id", parent, "pid").collect()
    assert sorted(r.id for r in orphans) == [2, 2]


def test_numeric_check_fires_for_every_measure_of_the_fact(spark):
    import frames
    from starloom.plans.contracts import warehouse_numeric_violations
    from starloom.plans.warehouse import Warehouse
    rows = [{"sales": Decimal("123456.0000")}, {"profit": Decimal("123456.5")}, {"discount": Decimal("100.00"), "order_id": "O2"}, {}]
    w = Warehouse(spark, frames.staging(spark, rows), frames.returns(spark, []), frames.managers(spark))
    assert _as_dict(warehouse_numeric_violations(w)) == {("sales_fact", c): 1 for c in ("sales", "profit", "discount")}


def test_bitmaps_find_planted_keys(spark):
    """Shared and NULL keys of several tables and buckets, counted as by key."""
    from pyspark.sql import functions as F
    clean = spark.range(100, 70_100).select(F.col("id"))
    planted = clean.unionByName(spark.createDataFrame([(100,), (100,), (65_000,), (None,), (None,), (-5,)], "id bigint"))
    contract = lambda name: TableContract(name, "id", (C("id"),))
    tables = [(clean, contract("clean")), (planted, contract("planted")), (clean.limit(0), contract("none")), (clean.select(F.col("id").cast("int")), contract("ints"))]
    assert _as_dict(dense_pk_violations(tables)) == _as_dict(pk_violations(tables)) == {
        ("clean", "id"): 0, ("planted", "id"): 7, ("none", "id"): 0, ("ints", "id"): 0}
    assert _as_dict(dense_pk_violations(tables[:1])) == {("clean", "id"): 0}


def test_counts_of_a_write_equal_those_of_a_scan(spark):
    import os
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-observed-"), "t")
    rows, counts = write_observed(_frame(spark), path, CONTRACT)
    again = spark.read.parquet(path)
    assert rows == again.count() == 4
    for check, violations in (("not_null", not_null_violations), ("length", length_violations), ("numeric", numeric_violations)):
        assert {("t", column): n for c, column, n in counts if c == check} == _as_dict(violations([(again, CONTRACT)]))
    assert write_observed(_frame(spark).limit(0), path + "0", CONTRACT)[0] == 0
