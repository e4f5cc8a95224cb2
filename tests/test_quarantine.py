"""Damaged CSV lines are set aside with their reasons; the others load."""

import os
import tempfile

import frames
import pytest

from starloom.sources.quarantine import WIDTH, read_staging_quarantined
from starloom.sources.staging import STAGING_COLUMNS


def test_exports_are_compressed(spark, monkeypatch):
    """What a query writes as CSV for itself takes a part of its text's size."""
    from conftest import SF_SMALL

    from starloom.plans import catalog
    folders = []
    own = catalog._own_folder
    monkeypatch.setattr(catalog, "_own_folder", lambda *a: folders.append(own(*a)) or folders[-1])
    for name in ("staging_quarantine", "staging_from_file", "returns_from_file"):
        assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    for folder in folders:
        files = os.listdir(folder.removeprefix("file:"))
        assert any(f.endswith(".gz") for f in files) and not any(f.endswith((".csv", ".txt")) for f in files)


def _csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-bad-"), "in.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def _line(**changes):
    values = {**{c: str(frames.DEFAULTS[c]) for c in STAGING_COLUMNS}, **changes}
    return ",".join(values[c] for c in STAGING_COLUMNS)


def test_bad_records_are_set_aside(spark):
    lines = [_line(order_id="G1"), _line(order_id="B1", sales="12 EUR", quantity="two"), _line(order_id="B2") + ",extra", "short,record",
             _line(order_id="G2", product_name='"big, ""red"" binder"', postal_code=""), _line(order_id="B3", order_date="11/08/2016")]
    read = read_staging_quarantined(spark, _csv("\n".join([",".join(STAGING_COLUMNS), *lines]) + "\n"), keep_line=True)
    good = {r.order_id: r for r in read.good.collect()}
    assert set(good) == {"G1", "G2"} and good["G1"].sales == frames.DEFAULTS["sales"]
    assert good["G2"].product_name == 'big, "red" binder' and good["G2"].postal_code is None
    assert read.good.columns == [*STAGING_COLUMNS, "_line"]
    bad = sorted((tuple(r.reasons), r.record) for r in read.bad.collect())
    assert [reasons for reasons, _ in bad] == [("order_date is no date",), (WIDTH,), (WIDTH,), ("sales is no decimal(11,4)", "quantity is no int")]
    assert "short,record" in [record for _, record in bad] and any('"sales":"12 EUR"' in record for _, record in bad)
    assert {r.reason: r.n for r in read.reasons().collect()} == {
        "order_date is no date": 1, WIDTH: 2, "sales is no decimal(11,4)": 1, "quantity is no int": 1}


def test_without_a_header_and_with_a_missing_column(spark):
    read = read_staging_quarantined(spark, _csv(_line() + "\n"), header=STAGING_COLUMNS)
    assert read.good.count() == 1 and read.bad.count() == 0
    with pytest.raises(ValueError, match="lacks the columns"):
        read_staging_quarantined(spark, _csv("order_id,sales\nA,1\n"))


def test_quarantined_lines_reach_the_fact(spark):
    from starloom.plans.warehouse import Warehouse
    path = _csv("\n".join([",".join(STAGING_COLUMNS), _line(order_id="A"), _line(order_id="B", discount="x"), _line(order_id="C")]) + "\n")
    good = read_staging_quarantined(spark, path, keep_line=True).good
    w = Warehouse(spark, good, frames.returns(spark, []), frames.managers(spark), share_staging=False)
    assert sorted(r.order_id for r in w.sales_fact.collect()) == ["A", "C"]
