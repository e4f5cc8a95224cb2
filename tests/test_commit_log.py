"""Versions claimed by create-if-absent: two writers never get the same number or key."""

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import frames
import pytest

from starloom.operators.commit_log import CommitLog
from starloom.operators.serial_append import append_log, append_with_serial, claim_keys
from starloom.plans import refresh
from starloom.plans.warehouse import Warehouse
from starloom.sources.seeds import RETURNS_SCHEMA


def _new(prefix):
    return tempfile.mkdtemp(prefix=f"starloom-{prefix}-")


def test_one_of_two_claims_of_a_number_wins(spark):
    log = CommitLog(spark, _new("log"))
    assert log.last() == (0, None)
    assert log.claim(1, {"by": "a"}) and not log.claim(1, {"by": "b"})
    assert log.last() == (1, {"by": "a"})
    assert sorted(os.listdir(log.folder)) == ["00000001.json"] or all(n.startswith((".", "0")) for n in os.listdir(log.folder))


def test_many_writers_at_once_get_numbers_of_their_own(spark):
    log = CommitLog(spark, _new("log"))
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: log.commit(lambda n, before: {"writer": i, "sum": (before or {"sum": 0})["sum"] + 1}), range(24)))
    assert sorted(number for number, _ in got) == list(range(1, 25)) == log.numbers()
    # every entry was made from the one before it
    assert sorted(entry["sum"] for _, entry in got) == list(range(1, 25))


def test_a_writer_that_comes_second_starts_after_the_first(spark):
    """The first reads the last version, then another commits, then the first claims."""
    log, seen = CommitLog(spark, _new("log")), []

    def slow(number, before):
        seen.append(number)
        if len(seen) == 1:
            log.commit(lambda n, b: {"next": 10})
        return {"next": (before or {"next": 0})["next"] + 5}

    assert log.commit(slow) == (2, {"next": 15}) and seen == [1, 2]


def test_appends_at_once_share_no_key(spark):
    path = os.path.join(_new("append"), "returns_dim")
    deliveries = [spark.createDataFrame([("Yes", f"O{d}-{i}") for i in range(7 + d)], RETURNS_SCHEMA) for d in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda rows: append_with_serial(spark, path, rows, "return_id", ["order_id"]), deliveries))
    rows = spark.read.parquet(path).collect()
    assert sorted(r.return_id for r in rows) == list(range(1, sum(7 + d for d in range(4)) + 1))
    # a delivery's keys follow each other in its own order
    for d in range(4):
        mine = sorted(((r.return_id, r.order_id) for r in rows if r.order_id.startswith(f"O{d}-")))
        assert [o for _, o in mine] == sorted(o for _, o in mine) and mine[-1][0] - mine[0][0] == 6 + d


def test_a_failed_append_leaves_a_gap_only(spark):
    path = os.path.join(_new("append"), "t")
    one = spark.createDataFrame([("Yes", "A")], RETURNS_SCHEMA)
    append_with_serial(spark, path, one, "return_id", ["order_id"])
    assert claim_keys(spark, path, "return_id", 5) == (2, 2)  # claimed, never written
    append_with_serial(spark, path, one, "return_id", ["order_id"])
    assert sorted(r.return_id for r in spark.read.parquet(path).collect()) == [1, 7]
    assert append_log(spark, path).last() == (3, {"first": 7, "next": 8})


def _warehouse(spark, orders):
    return Warehouse(spark, frames.staging(spark, [{"order_id": o} for o in orders]), frames.returns(spark, orders[:1]), frames.managers(spark))


def test_two_loads_at_once_are_both_published(spark):
    out = _new("dw")
    loads = [["A"], ["B1", "B2"]]
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda orders: refresh.run(_warehouse(spark, orders), out), loads))
    assert sorted(r["version"] for r in results) == [1, 2]
    for orders, result in zip(loads, results):
        fact = refresh.read_warehouse(spark, out, result["version"])["sales_fact"]
        assert sorted(r.order_id for r in fact.collect()) == orders
    last = max(results, key=lambda r: r["version"])
    assert refresh.read_warehouse(spark, out)["sales_fact"].count() == last["reconciliation"]["fact_rows"]


def test_old_versions_can_be_read_and_removed(spark):
    out = _new("dw")
    for orders in (["A"], ["A", "B"], ["A", "B", "C"]):
        refresh.run(_warehouse(spark, orders), out)
    assert {n: e["rows"]["sales_fact"] for n, e in refresh.history(spark, out).items()} == {1: 1, 2: 2, 3: 3}
    assert refresh.read_warehouse(spark, out, version=1)["sales_fact"].count() == 1
    os.makedirs(os.path.join(out, "load-abandoned"))
    gone = refresh.vacuum(spark, out, keep=2)
    assert len(gone) == 1 and os.path.isdir(os.path.join(out, "load-abandoned"))  # young: it may still run
    assert refresh.vacuum(spark, out, keep=2, unpublished_after=-1) == ["load-abandoned"]
    assert [refresh.read_warehouse(spark, out, v)["sales_fact"].count() for v in (2, 3)] == [2, 3]
    with pytest.raises(ValueError, match="no version 1"):
        refresh.read_warehouse(spark, out, version=1)
    refresh.vacuum(spark, out, keep=1)
    assert refresh.run(_warehouse(spark, ["D"]), out)["version"] == 4  # numbers go on
    with pytest.raises(ValueError):
        refresh.vacuum(spark, out, keep=0)
    with pytest.raises(ValueError, match="no version"):
        refresh.read_warehouse(spark, _new("none"))


def test_a_refresh_leaves_nothing_of_its_own(spark):
    import glob

    from starloom.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    refresh.run(_warehouse(spark, ["A"]), _new("dw"))
    assert not glob.glob(f"{folder}/scratch-*")
