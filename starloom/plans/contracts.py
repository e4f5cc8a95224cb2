"""The warehouse's declared constraints and the checks over a built warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.operators.contracts import (
    ColumnContract as C,
    TableContract,
    dense_pk_violations,
    fk_violations,
    length_violations,
    not_null_violations,
    numeric_violations,
    pk_violations,
    violating_rows,
)
from starloom.plans.warehouse import Warehouse

# Keys, NOT NULL columns, varchar lengths and numeric
# precisions of the warehouse tables as declared.
CONTRACTS = {
    "shipping_dim": TableContract("shipping_dim", "ship_id", (
        C("ship_id"), C("shipping_mode", max_length=14))),
    "customer_dim": TableContract("customer_dim", "cust_id", (
        C("cust_id"), C("customer_id", max_length=8), C("customer_name", max_length=22))),
    "geo_dim": TableContract("geo_dim", "geo_id", (
        C("geo_id"), C("country", max_length=13), C("city", max_length=17), C("state", max_length=20),
        C("postal_code", nullable=True, max_length=20))),
    "product_dim": TableContract("product_dim", "prod_id", (
        C("prod_id"), C("product_id", max_length=50), C("product_name", max_length=127),
        C("category", max_length=15), C("sub_category", max_length=11), C("segment", max_length=11))),
    "calendar_dim": TableContract("calendar_dim", "dateid", (
        C("dateid"), C("year"), C("quarter"), C("month"), C("week"), C("date"),
        C("week_day", max_length=20), C("leap", max_length=20))),
    "sales_fact": TableContract("sales_fact", "sales_id", (
        C("sales_id"), C("cust_id"), C("order_date_id"), C("ship_date_id"), C("prod_id"), C("ship_id"),
        C("geo_id"), C("order_id", max_length=25), C("sales", decimal=(9, 4)), C("profit", decimal=(21, 16)),
        C("quantity"), C("discount", decimal=(4, 2)), C("return_id", nullable=True),
        C("manager_id", nullable=True))),
    "returns_dim": TableContract("returns_dim", "return_id", (
        C("return_id"), C("returned", max_length=10), C("order_id", max_length=20))),
    "managers_dim": TableContract("managers_dim", "manager_id", (
        C("manager_id"), C("manager", max_length=17), C("region", max_length=7))),
}

TABLE_ORDER = list(CONTRACTS)


def warehouse_tables(w: Warehouse) -> list[tuple[DataFrame, TableContract]]:
    """Each table with its contract.  The fact is checked before enrichment:
    the updates keep its rows, and the key, NOT NULL, length and numeric
    contracts involve none of the two added (nullable, unbounded) columns."""
    frames = {
        "shipping_dim": w.shipping.df,
        "customer_dim": w.customer.df,
        "geo_dim": w.geo.df,
        "product_dim": w.product.df,
        "calendar_dim": w.calendar(),
        "sales_fact": w.sales_fact,
        "returns_dim": w.returns_dim,
        "managers_dim": w.managers_dim,
    }
    return [(frames[name], CONTRACTS[name]) for name in TABLE_ORDER]


def warehouse_pk_violations(w: Warehouse) -> DataFrame:
    """By bitmaps: the tables come as they were numbered, so a task's keys lie together."""
    return dense_pk_violations(warehouse_tables(w))


def warehouse_not_null_violations(w: Warehouse) -> DataFrame:
    return not_null_violations(warehouse_tables(w))


def warehouse_length_violations(w: Warehouse) -> DataFrame:
    return length_violations(warehouse_tables(w))


def warehouse_numeric_violations(w: Warehouse) -> DataFrame:
    return numeric_violations([(w.sales_fact, CONTRACTS["sales_fact"])])


def warehouse_fk_violations(w: Warehouse) -> DataFrame:
    """Foreign keys of the enriched fact (the only check that needs it)."""
    fact = w.sales_fact_with_managers
    return (fk_violations(fact, "sales_fact", "return_id", w.returns_dim, "return_id")
            .unionByName(fk_violations(fact, "sales_fact", "manager_id", w.managers_dim, "manager_id")))


def key_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The checks over stored warehouse tables that one row alone cannot tell, by check name.

    ``tables`` maps table name -> frame (e.g. the tables a full refresh has
    just written, read back), so the checks see exactly what was stored.
    """
    pairs = [(tables[name], CONTRACTS[name]) for name in TABLE_ORDER if name in tables]
    fact = tables["sales_fact"]
    return {
        "primary_key": pk_violations(pairs),
        "foreign_key": fk_violations(fact, "sales_fact", "return_id", tables["returns_dim"], "return_id")
        .unionByName(fk_violations(fact, "sales_fact", "manager_id", tables["managers_dim"], "manager_id")),
    }


def table_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All constraint checks over stored warehouse tables, by check name."""
    pairs = [(tables[name], CONTRACTS[name]) for name in TABLE_ORDER if name in tables]
    return {
        **key_checks(tables),
        "not_null": not_null_violations(pairs),
        "length": length_violations(pairs),
        "numeric": numeric_violations([(tables["sales_fact"], CONTRACTS["sales_fact"])]),
    }


FK_PARENTS = {"return_id": ("returns_dim", "return_id"), "manager_id": ("managers_dim", "manager_id")}


def sample_violations(tables: dict[str, DataFrame], check: str, table: str, column: str,
                      n: int = 3) -> list[dict]:
    """Up to ``n`` rows of a stored table that break one check (an incremental take)."""
    parent = parent_key = None
    if check == "foreign_key":
        parent_name, parent_key = FK_PARENTS[column]
        parent = tables[parent_name]
    rows = violating_rows(tables[table], CONTRACTS[table], check, column, parent, parent_key).take(n)
    return [r.asDict() for r in rows]
