"""Run a registered query in Spark and its SQL twin in DuckDB and compare.

Comparison is order-insensitive: columns are matched by name, rows are
sorted, values are compared by type and text (decimals with their scale, dates
and strings as they are).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))  # scale included: 1.50 and 1.5 differ
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("t", v.isoformat())
    if v is None:
        return ("n", "")
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("i", str(v))
    return ("s", str(v))


_TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def _duck_type(spark_type: str) -> str:
    return _TYPE_NAMES.get(spark_type, spark_type.upper())


def compare(spark_df, con, sql: str) -> dict:
    spark_types = {f.name: _duck_type(f.dataType.simpleString()) for f in spark_df.schema.fields}
    duck_types = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    spark_cols = spark_df.columns
    spark_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_rows = cur.fetchall()
    out = {"spark_rows": len(spark_rows), "oracle_rows": len(duck_rows),
           "spark_cols": spark_cols, "oracle_cols": duck_cols}
    if sorted(spark_cols) != sorted(duck_cols):
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    if spark_types != duck_types:
        out["ok"] = False
        out["why"] = f"types differ: {spark_types} vs {duck_types}"
        return out
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    out["ok"] = a == b
    if not out["ok"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["why"] = f"values differ; spark-only {diff_a}; oracle-only {diff_b}"
    return out
