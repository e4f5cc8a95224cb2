"""Corpus queries that SQL can express, against DuckDB over whole tables."""

import os

import duckdb
import pytest
from conftest import SF_SMALL
from oracle_compare import compare

from starloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, table + '.parquet')}')")
    result = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE_SQL[name])
    assert result["ok"], result


def test_every_operator_is_registered():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))
