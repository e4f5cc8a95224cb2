"""The warehouse on hand-written frames: grain, NULL keys, repair order, enrichment."""

import frames
from pyspark.sql import functions as F

from starloom.plans import audits
from starloom.plans.warehouse import Warehouse


def _warehouse(spark, rows, returned=(), managers=None):
    return Warehouse(spark, frames.staging(spark, rows), frames.returns(spark, list(returned)),
                     frames.managers(spark, managers))


def test_product_grain_includes_segment(spark):
    w = _warehouse(spark, [{"segment": "Consumer"}, {"segment": "Corporate"}, {"segment": "Consumer"}])
    prod = w.product.df.collect()
    assert w.product.rows == 2
    assert sorted(r.segment for r in prod) == ["Consumer", "Corporate"]
    assert sorted(r.prod_id for r in prod) == [101, 102]
    assert w.fact.rows == 3


def test_null_key_does_not_match_in_star_join(spark):
    # before the repair, a NULL postal code matches no geography row
    w = _warehouse(spark, [{"city": "Burlington", "postal_code": None}, {}])
    assert w.unrepaired_fact_lines().count() == 1
    assert w.fact.rows == 2


def test_repair_collision_yields_one_geo_row(spark):
    rows = [{"city": "Burlington", "state": "Vermont", "postal_code": None},
            {"city": "Burlington", "state": "Vermont", "postal_code": "05401"}]
    w = _warehouse(spark, rows)
    assert w.geo_unrepaired.rows == 2
    assert w.geo.rows == 1
    assert w.fact.rows == 2
    assert w.sales_fact.select("geo_id").distinct().count() == 1


def test_geo_completeness_ignores_state(spark):
    rows = [{"state": None}, {"country": None}, {"city": "Burlington", "postal_code": None}]
    got = audits.geo_completeness_audit(frames.staging(spark, rows)).collect()
    assert {(r.country, r.city, r.postal_code) for r in got} == {
        (None, "Henderson", "42420"), ("United States", "Burlington", None)}


def test_fact_keys_dense_and_fact_count_equals_staging(spark):
    rows = [{"order_id": f"CA-2016-{i:06d}", "quantity": i} for i in range(50)]
    w = _warehouse(spark, rows)
    ids = sorted(r.sales_id for r in w.sales_fact.collect())
    assert ids == list(range(101, 151))


def test_returns_and_managers_enrichment(spark):
    rows = [{"order_id": "O1", "region": "AFRICA"}, {"order_id": "O1", "region": "AFRICA", "quantity": 3},
            {"order_id": "O2", "region": "MIDDLE EAST"}, {"order_id": "O3", "region": "ASIA"}]
    w = _warehouse(spark, rows, returned=["O3", "O1", "O1"])
    # returns numbered by order id: O1 -> 1, 2; O3 -> 3
    assert sorted(tuple(r) for r in w.returns_dim.collect()) == [(1, "Yes", "O1"), (2, "Yes", "O1"),
                                                                 (3, "Yes", "O3")]
    out = {(r.order_id, r.quantity): (r.return_id, r.manager_id) for r in w.sales_fact_with_managers.collect()}
    assert out == {("O1", 2): (1, 1), ("O1", 3): (1, 1), ("O2", 2): (None, None), ("O3", 2): (3, 3)}
    assert w.sales_fact_with_managers.count() == len(rows)


def _listed_audit(w):
    """Every row of the audit, listed in Python from the tiny frames: for each line of the fact one row
    for each staging line of its order."""
    heads = {r.manager_id: r for r in w.managers_dim.collect()}
    order_lines = {}
    for r in w.staging.select("order_id", "region").collect():
        order_lines.setdefault(r.order_id, []).append(r.region)
    rows = []
    for r in w.sales_fact_with_managers.collect():
        head = heads.get(r.manager_id)
        for region in order_lines.get(r.order_id, [None]):
            rows.append((r.sales_id, r.order_id, head and head.manager_id, head and head.manager, head and head.region, region))
    return sorted(rows, key=lambda x: (x[0], x[5] is not None, x[5] or ""))


def test_manager_audit_matches_brute_force(spark):
    rows = ([{"order_id": "O1", "region": "AFRICA", "quantity": q} for q in range(12)]
            + [{"order_id": "O2", "region": "MIDDLE EAST", "quantity": q} for q in range(3)]
            + [{"order_id": "O0", "region": "ASIA", "quantity": q} for q in range(2)])
    w = _warehouse(spark, rows)
    listed = _listed_audit(w)
    expect = listed[:20]
    got = [tuple(r) for r in audits.manager_assignment_audit(w).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
    n = audits.manager_audit_fanout(w.sales_fact, w.staging).first().n
    assert n == len(listed) == 12 * 12 + 3 * 3 + 2 * 2


def test_rebuild_is_deterministic_across_partition_counts(spark):
    from conftest import SF_SMALL
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            w = Warehouse.from_fixture(spark, SF_SMALL)
            results.append(sorted(tuple(r) for r in w.sales_fact_with_managers.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(results[0]) == 6000
    assert results[0] == results[1]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@settings(max_examples=4, deadline=None, derandomize=True, database=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders=st.lists(st.tuples(st.integers(1, 9), st.sampled_from(REGIONS), st.integers(0, 3)),
                       min_size=1, max_size=8))
def test_audits_match_brute_force_on_random_orders(spark, orders):
    # each order: (lines, region, returned lines); order ids sort in list order
    rows, returned = [], []
    for i, (lines, region, n_ret) in enumerate(orders):
        oid = f"CA-2016-{i:06d}"
        rows += [{"order_id": oid, "region": region, "quantity": q} for q in range(lines)]
        returned += [oid] * n_ret
    w = _warehouse(spark, rows, returned=returned)
    listed = _listed_audit(w)
    expect = listed[:20]
    got = [tuple(r) for r in audits.manager_assignment_audit(w).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
    assert audits.manager_audit_fanout(w.sales_fact, w.staging).first().n == len(listed)
    preview = [tuple(r) for r in audits.returns_preview(w).collect()]
    assert preview == [tuple(r) for r in w.sales_fact_with_returns.orderBy("sales_id").limit(10).collect()]


def test_hot_order_with_a_third_of_all_lines(spark):
    # one order id takes a third of the fixture's lines (chosen by their lineage value)
    from conftest import SF_SMALL
    # keep the range partitions as cut (on 6,000 rows adaptive execution would
    # otherwise merge them all into one)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_hot_order(spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_hot_order(spark, sf_dir):
    from pyspark.sql.functions import spark_partition_id

    from starloom.sources.seeds import fixture_returns, managers_seed
    from starloom.sources.staging import fixture_staging
    staging = fixture_staging(spark, sf_dir, keep_line=True)
    hot = F.pmod(F.col("_line"), F.lit(3)) == 0
    skewed = staging.withColumn("order_id", F.when(hot, F.lit("CA-2000-HOTHOT")).otherwise(F.col("order_id")))
    w = Warehouse(spark, skewed, fixture_returns(spark, sf_dir), managers_seed(spark))
    hot_lines = w.staging.filter(F.col("order_id") == "CA-2000-HOTHOT").count()
    assert 1500 < hot_lines < 2500
    assert w.fact.rows == 6000
    # the audit's fan-out count, computed from per-order counts, equals the sum of squared order sizes
    sizes = [r["count"] for r in w.staging.groupBy("order_id").count().collect()]
    assert audits.manager_audit_fanout(w.sales_fact, w.staging).first().n == sum(n * n for n in sizes)
    # the range sort behind sales_id spreads the hot order over several partitions
    parts = [r["count"] for r in w.sales_fact.groupBy(spark_partition_id()).count().collect()]
    assert max(parts) < hot_lines
    # the enriched fact keeps one row per line
    assert w.sales_fact_with_managers.count() == 6000


def test_coded_joins_equal_broadcast_ones(spark, monkeypatch):
    """Large dimensions meet the lines by codes; NULL attributes match nothing, whatever their place; clashes take another seed."""
    from starloom.plans import warehouse
    rows = [{"order_id": f"O{i % 7}", "customer_id": f"C{i % 5}", "customer_name": "Ann", "product_name": f"p{i % 3}", "quantity": i} for i in range(40)]
    rows += [{"customer_id": None, "customer_name": "Ann"}, {"customer_id": "Ann", "customer_name": None}, {"order_id": None}, {"order_id": None},
             {"customer_id": "Ann", "customer_name": "Bob"}, {"city": "Burlington", "postal_code": None}, {"segment": None}]
    results = []
    for most, codes in ((50_000, 0), (0, 1_000_000), (0, 0)):
        monkeypatch.setattr(warehouse, "BROADCAST_ROWS", most)
        monkeypatch.setattr(warehouse, "BROADCAST_CODES", codes)
        w = _warehouse(spark, rows, returned=["O1", "O1", "O3"])
        results.append((sorted(map(str, w.sales_fact_with_managers.collect())), w.unrepaired_fact_lines().count()))
    assert len(results[0][0]) == 44 and results[0][1] == 43
    assert results[0] == results[1] == results[2]
    monkeypatch.setattr(warehouse, "code", lambda columns, seed: (F.lit(7) if seed < 2 else F.xxhash64(*columns)).alias("_code"))
    assert warehouse.code_seed(spark.range(3), ["id"]) == 2


def test_large_dimensions_are_not_broadcast_to_count_the_fact(spark, monkeypatch):
    """Whatever the session's threshold; lines of unknown, NULL and repeated keys count as an inner join has them."""
    from starloom.operators.dense_ids import Numbered
    from starloom.operators.materialize import stored
    keys = ["ship_id", "geo_id", "prod_id", "cust_id"]
    fact = spark.createDataFrame([(101, 101, 101 + i % 4, 101 + i % 3) for i in range(12)] + [(101, 101, 101, None), (101, 101, 999, 101)],
                                 ", ".join(f"{k} long" for k in keys))
    dims = [Numbered(stored(spark.createDataFrame([(r, f"n{r}") for r in rows], f"{k} long, name string")), len(rows))
            for k, rows in zip(keys, ([101], [101], [101, 102, 103, 104], [101, 102, 103, 103]))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        for most, broadcasts in ((50_000, 4), (1, 2), (0, 0)):
            monkeypatch.setattr(audits, "BROADCAST_ROWS", most)
            joined = audits.fact_dimension_join(fact, *dims)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastExchange") == broadcasts, plan
            assert joined.count() == 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_updates_of_many_orders_are_not_broadcast(spark, monkeypatch):
    """Whatever the session's threshold: neither to enrich the fact nor to check what it was given."""
    from starloom.plans import warehouse
    from starloom.plans.contracts import warehouse_fk_violations
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        results = []
        for most in (50_000, 2):
            monkeypatch.setattr(warehouse, "BROADCAST_ROWS", most)
            w = _warehouse(spark, [{"order_id": f"O{i % 5}", "quantity": i} for i in range(12)] + [{"order_id": None}], returned=["O1", "O1", "O9", None])
            fact = w.sales_fact_with_managers
            plans = [df._jdf.queryExecution().executedPlan().toString() for df in (fact, warehouse_fk_violations(w))]
            assert ["BroadcastHashJoin" in plan for plan in plans] == [most > 2] * 2, plans
            results.append((sorted(map(str, fact.collect())), sorted(map(str, warehouse_fk_violations(w).collect()))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(results[0][0]) == 13 and results[0] == results[1]


def test_lines_travel_narrow(spark, monkeypatch):
    """A line that is shuffled to a large dimension or to its range carries no text but its order."""
    import re

    from conftest import SF_SMALL

    from starloom.plans import warehouse
    monkeypatch.setattr(warehouse, "BROADCAST_ROWS", 140)
    monkeypatch.setattr(warehouse, "BROADCAST_CODES", 0)
    w = Warehouse.from_fixture(spark, SF_SMALL)
    assert "_line" not in w.staging_raw.columns and w.staging_base.select("_line").distinct().count() == 6000
    lines = warehouse.star_join(w.staging, w.shipping, w.geo, w.product, w.customer)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    sides = [part for part in re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)]
    assert len(sides) == 2 and all("_code" in s for s in sides), plan


def test_lines_in_buckets_of_the_product_stay_there(spark, monkeypatch):
    """A large product dimension comes to the lines, which lie by product id; hot products go the way of codes.  The fact is the same."""
    from conftest import SF_SMALL

    from starloom.plans import warehouse
    from starloom.sources.staging import fixture_staging
    usual = sorted(map(str, Warehouse.from_fixture(spark, SF_SMALL).sales_fact.collect()))
    tables = spark.catalog.listTables()
    monkeypatch.setattr(warehouse, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warehouse, "BROADCAST_CODES", 0)
    w = Warehouse.from_fixture(spark, SF_SMALL)
    assert w.even_bucket == "product_id"
    assert sorted(map(str, w.sales_fact.collect())) == usual
    assert spark.catalog.listTables() == tables
    exchanges = []
    with warehouse._joins_by_some_keys(spark):
        for bucket in (None, "product_id"):
            lines = warehouse.star_join(w.staging, w.shipping, w.geo, w.product, w.customer, bucket)
            exchanges.append(lines._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
    assert exchanges == [8, 7]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    hot = fixture_staging(spark, SF_SMALL).withColumn("product_id", F.lit("P-00000001"))
    crowded = Warehouse(spark, hot, w.returns_seed, w.managers_dim, bucket="product_id")
    assert crowded.even_bucket is None and crowded.fact.rows == 6000


def test_lines_by_product_are_the_same(spark, tmp_path, monkeypatch):
    """Parts joined by product id, nations after the lines' shuffles: the rows of the join by keys, with repeated and NULL keys."""
    from starloom.sources import staging as source

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("lineitem", [(o, p, 3.0, 10.5, 0.1, "1996-01-02") for o in (1, 1, 2, None) for p in (7, 123456789, -5, None)],
          "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate string")
    write("orders", [(1, 4, "1995-05-05", "1-URGENT"), (2, 5, "1995-05-06", "5-LOW"), (2, 6, None, None), (None, 4, None, None)],
          "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string")
    write("customer", [(4, "Ann", 0, "A"), (5, None, 1, None), (5, "Bob", 2, "B"), (6, "Cid", None, "C")],
          "c_custkey long, c_name string, c_nationkey long, c_mktsegment string")
    write("part", [(7, "x", "b", "t"), (7, "y", None, "t"), (123456789, "z", "b", "t"), (-5, "m", "b", "t"), (None, "n", "b", "t")],
          "p_partkey long, p_name string, p_brand string, p_type string")
    write("nation", [(0, "N0", 0), (0, "N00", 0), (1, None, 0), (2, "N2", None), (None, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    write("region", [(0, "R0")], "r_regionkey long, r_name string")
    rows = []
    for few, by_product in ((10_000, False), (10_000, True), (0, False), (0, True)):
        monkeypatch.setattr(source, "FEW_NATIONS", few)
        rows.append(sorted(map(str, source.fixture_staging(spark, str(tmp_path), by_product=by_product).collect())))
    # 2 lines of order 1 at two nations, 1 of order 2 at one; part 7 twice, the others once
    assert len(rows[0]) == (2 * 2 + 1) * 4
    assert rows[0] == rows[1] == rows[2] == rows[3]


def test_manager_of_an_unknown_region_is_kept_and_reported(spark):
    from conftest import SF_SMALL
    from starloom.sources.seeds import managers_by_region
    rows = managers_by_region(spark, SF_SMALL, [("Ann", "ASIA"), ("Bob", "ATLANTIS")]).collect()
    assert sorted(map(tuple, rows)) == [(1, "Ann", "ASIA", True), (2, "Bob", "ATLANTIS", False)]
