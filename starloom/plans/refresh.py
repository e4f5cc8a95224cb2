"""The full refresh: build every warehouse table, check the result, publish it.

Order of the run:

1. staging is read and written once (the repaired lines are a projection
   over it) and written as ``stg_orders`` so later readers see the repair;
2. the four dimensions, the calendar (widened to cover every date of the
   input), the returns and managers tables;
3. the sales fact with ``return_id`` and ``manager_id``;
4. the quality report and the staging/fact reconciliation.  Row counts and the NOT NULL, length and numeric
   checks are metrics of the jobs that write the tables; the key and foreign-key checks
   and the joined count read the tables as written (nothing is recomputed);
5. publication: the load claims the next version in ``<out>/_log`` (see ``operators.commit_log``).

A load writes to a folder of its own, ``<out>/<name>``, and readers follow the last
published version, or any older one by its number.  Of two loads at once both are published, under numbers of
their own.  A load that fails, or whose counts differ, publishes nothing: the
tables of the load before it stay readable.  ``vacuum`` removes old versions and loads that were never published;
what a run writes for itself it removes at its end.

Command line::

    python -m starloom.plans.refresh --tables /path/to/fixture --out /path/to/dw [--strict] [--database dw]
    python -m starloom.plans.refresh --staging /path/stg_orders --returns /path/returns.csv --out /path/to/dw
"""

from __future__ import annotations

import argparse
import time
import uuid
from copy import copy
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.commit_log import CommitLog, file_system, remove_folder
from starloom.operators.contracts import write_observed
from starloom.operators.dense_ids import Numbered
from starloom.operators.materialize import scratch
from starloom.plans.audits import fact_dimension_join
from starloom.plans.contracts import CONTRACTS, key_checks, sample_violations, table_checks
from starloom.plans.warehouse import Warehouse
from starloom.sources.seeds import managers_seed, read_returns
from starloom.sources.tables import literal_rows

TABLES = ["stg_orders", "shipping_dim", "customer_dim", "geo_dim", "product_dim", "calendar_dim",
          "returns_dim", "managers_dim", "sales_fact"]


def warehouse_frames(w: Warehouse) -> dict[str, DataFrame]:
    return {
        "stg_orders": w.staging_public,
        "shipping_dim": w.shipping.df,
        "customer_dim": w.customer.df,
        "geo_dim": w.geo.df,
        "product_dim": w.product.df,
        "calendar_dim": w.calendar(),
        "returns_dim": w.returns_dim,
        "managers_dim": w.managers_dim,
        # rows of a partition sorted by order (its id starts with the year) and
        # key: tight min/max per Parquet row group for readers that filter on
        # them; a local sort, no extra shuffle
        "sales_fact": w.sales_fact_with_managers.sortWithinPartitions("order_id", "sales_id"),
    }


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All constraint checks over stored tables as ``(check, table_name, column_name, n)``."""
    parts = [report.select(F.lit(check).alias("check"), "*") for check, report in table_checks(tables).items()]
    return reduce(DataFrame.unionByName, parts)


def run(w: Warehouse, out_root: str, strict: bool = False, database: str | None = None,
        allow_difference: bool = False) -> dict:
    """Write every table, the quality report and the reconciliation; publish them if they hold.

    A fact that lost or gained staging lines, or lines that do not resolve all
    dimensions, raises ``ValueError`` unless ``allow_difference``; with
    ``strict`` so does any violation.  Nothing is published then.  With ``database`` the
    published tables are also registered in that Spark database (created if missing),
    so they read back as ``spark.table("<database>.sales_fact")``.  Returns the version, the
    reconciliation counts and the failing checks.
    """
    with scratch(w.spark):
        # a copy: what the run builds goes with its scratch folder, what ``w`` has built before is used
        return _run(copy(w), out_root, strict, database, allow_difference)


def _run(w: Warehouse, out_root: str, strict: bool, database: str | None, allow_difference: bool) -> dict:
    name = f"load-{uuid.uuid4().hex}"
    folder = f"{out_root}/{name}"
    rows, observed = {}, []
    for table, df in warehouse_frames(w).items():
        rows[table], counts = write_observed(df, f"{folder}/{table}", CONTRACTS.get(table))
        observed += [(check, table, column, n) for check, column, n in counts]
    written = _tables(w.spark, folder)
    keyed = [report.select(F.lit(check).alias("check"), "*") for check, report in key_checks(written).items()]
    report = reduce(DataFrame.unionByName, [*keyed, literal_rows(w.spark, ["check", "table_name", "column_name", "n"], observed)])
    report.write.parquet(f"{folder}/quality_report")
    dims = [Numbered(written[dim], rows[dim]) for dim in ("shipping_dim", "geo_dim", "product_dim", "customer_dim")]
    joined = fact_dimension_join(written["sales_fact"], *dims).count()
    counts = {"staging_rows": rows["stg_orders"], "fact_rows": rows["sales_fact"], "joined_rows": joined}
    failing = [r.asDict() for r in w.spark.read.parquet(f"{folder}/quality_report").filter(F.col("n") > 0).collect()]
    if (strict and failing) or (len(set(counts.values())) != 1 and not allow_difference):
        samples = {f"{v['check']} {v['table_name']}.{v['column_name']} ({v['n']} rows)":
                   sample_violations(written, v["check"], v["table_name"], v["column_name"]) for v in failing}
        raise ValueError(f"warehouse checks failed, nothing published: counts={counts}, violations={samples}")
    number, _ = publication_log(w.spark, out_root).commit(
        lambda _number, _before: {"folder": name, "published": int(time.time()), "rows": rows})
    if database:
        w.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table in TABLES:
            w.spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
            w.spark.catalog.createTable(f"{database}.{table}", path=f"{folder}/{table}", source="parquet")
    return {"version": number, "folder": name, "reconciliation": counts, "violations": failing}


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}


def publication_log(spark: SparkSession, out_root: str) -> CommitLog:
    return CommitLog(spark, f"{out_root}/_log")


def history(spark: SparkSession, out_root: str) -> dict[int, dict]:
    """Published versions: number -> folder, time of publication, rows by table."""
    log = publication_log(spark, out_root)
    return {number: log.entry(number) for number in log.numbers()}


def version_folder(spark: SparkSession, out_root: str, version: int | None = None) -> str:
    """The folder of a published version, by default of the last."""
    log = publication_log(spark, out_root)
    numbers = log.numbers()
    if not numbers or (version is not None and version not in numbers):
        raise ValueError(f"no version {'' if version is None else version} in {out_root}; published: {numbers}")
    return f"{out_root}/{log.entry(numbers[-1] if version is None else version)['folder']}"


def read_warehouse(spark: SparkSession, out_root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a published version, by name; by default the last one's."""
    return _tables(spark, version_folder(spark, out_root, version))


def read_quality_report(spark: SparkSession, out_root: str, version: int | None = None) -> DataFrame:
    """The quality report ``(check, table_name, column_name, n)`` of a published version."""
    return spark.read.parquet(f"{version_folder(spark, out_root, version)}/quality_report")


def vacuum(spark: SparkSession, out_root: str, keep: int, unpublished_after: float = 24 * 3600) -> list[str]:
    """Remove all but the last ``keep`` (at least 1) published versions, and load folders that
    no version names and that are older than ``unpublished_after`` seconds (younger ones may be loads that still run).

    Returns the removed folders.  A version's entry goes before its files, so a listed version is always whole.
    """
    if keep < 1:
        raise ValueError("at least the last version is kept")
    log = publication_log(spark, out_root)
    published = history(spark, out_root)
    numbers = sorted(published)
    gone = [published[n]["folder"] for n in numbers[:-keep]]
    for n in numbers[:-keep]:
        log.forget(n)
    named = {entry["folder"] for entry in published.values()}
    fs, root = file_system(spark, out_root)
    for status in fs.listStatus(root):
        name, age = status.getPath().getName(), time.time() - status.getModificationTime() / 1000
        if status.isDirectory() and name.startswith("load-") and name not in named and age > unpublished_after:
            gone.append(name)
    for name in gone:
        remove_folder(spark, f"{out_root}/{name}")
    return gone


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose tables as temporary views under their names, so SQL written
    against the warehouse (``SELECT ... FROM sales_fact sf JOIN geo_dim g ...``)
    runs unchanged through ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def main(argv: list[str] | None = None) -> None:
    from starloom.session import build_session
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder with the fixture tables (<name>.parquet)")
    source.add_argument("--staging", help="a stored staging table with the staging columns (see --staging-format)")
    parser.add_argument("--returns", help="returns list (CSV with header returned,order_id); with --staging")
    parser.add_argument("--staging-format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--out", required=True, help="output root for the warehouse tables")
    parser.add_argument("--master", default=None)
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--allow-difference", action="store_true", help="publish a fact whose counts differ from staging")
    parser.add_argument("--database", default=None, help="also register the tables in this Spark database")
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    if args.tables:
        w = Warehouse.from_fixture(spark, args.tables)
    else:
        if not args.returns:
            parser.error("--staging needs --returns")
        w = Warehouse.from_staging_table(spark, args.staging, read_returns(spark, args.returns),
                                         managers_seed(spark), fmt=args.staging_format)
    result = run(w, args.out, strict=args.strict, database=args.database, allow_difference=args.allow_difference)
    print(result)


if __name__ == "__main__":
    main()
