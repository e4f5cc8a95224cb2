"""Declared table constraints, checked as data-quality queries.

Parquet tables do not enforce keys, NOT NULL, lengths or decimal ranges, so
each constraint becomes a query that counts violating rows.  Every check
returns ``(table_name, column_name, n)`` with one row per checked column
(``n = 0`` when clean).  The per-column checks of a table run as one
aggregate pass, or as observed metrics of the job that writes it; the key check shuffles bitmaps of
dense keys, or the key column.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.materialize import stored
from starloom.sources.tables import literal_rows

CHECK_COLUMNS = ["table_name", "column_name", "n"]


@dataclass(frozen=True)
class ColumnContract:
    name: str
    nullable: bool = False
    max_length: int | None = None          # varchar(n)
    decimal: tuple[int, int] | None = None  # numeric(p, s)


@dataclass(frozen=True)
class TableContract:
    name: str
    key: str | None
    columns: tuple[ColumnContract, ...] = field(default_factory=tuple)

    def column(self, name: str) -> ColumnContract:
        return next(c for c in self.columns if c.name == name)


def _count_when(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def column_counts(contract: TableContract) -> dict[str, dict[str, Column]]:
    """Check -> column -> aggregate that counts its violations, for every per-column check of a table."""
    def misfit(col: ColumnContract) -> Column:
        p, s = col.decimal
        return F.col(col.name).isNotNull() & F.col(col.name).try_cast(T.DecimalType(p, s)).isNull()

    return {
        "not_null": {c.name: _count_when(F.col(c.name).isNull()) for c in contract.columns if not c.nullable},
        "length": {c.name: _count_when(F.length(c.name) > c.max_length) for c in contract.columns if c.max_length is not None},
        # values that do not fit the declared numeric(p, s): try_cast gives NULL
        "numeric": {c.name: _count_when(misfit(c)) for c in contract.columns if c.decimal},
    }


def _per_column(df: DataFrame, table: str, counts: dict[str, Column]) -> DataFrame | None:
    """One aggregate pass, unpivoted to one row per column."""
    if not counts:
        return None
    wide = df.agg(*[c.cast("long").alias(name) for name, c in counts.items()])
    return (wide.unpivot([], list(counts), "column_name", "n")
            .select(F.lit(table).alias("table_name"), "column_name", F.col("n").cast("long").alias("n")))


def _union(parts: list[DataFrame | None]) -> DataFrame:
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts)


def _column_violations(check: str, tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    return _union([_per_column(df, c.name, column_counts(c)[check]) for df, c in tables])


def not_null_violations(tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    return _column_violations("not_null", tables)


def length_violations(tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    return _column_violations("length", tables)


def numeric_violations(tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    return _column_violations("numeric", tables)


def write_observed(df: DataFrame, path: str, contract: TableContract | None = None) -> tuple[int, list[tuple[str, str, int]]]:
    """Write ``df`` as Parquet and count, in the same job, its rows and each violation of its per-column checks.

    Returns the row count and (check, column, n) rows; the counts are metrics that the writing tasks report, so
    the table is not scanned again.
    """
    counts = [(check, column, metric) for check, columns in (column_counts(contract) if contract else {}).items() for column, metric in columns.items()]
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[metric.alias(f"m{i}") for i, (_, _, metric) in enumerate(counts)])
    observed.write.parquet(path, compression="zstd")
    got = seen.get
    return got["rows"], [(check, column, got[f"m{i}"]) for i, (check, column, _) in enumerate(counts)]


def dense_pk_violations(tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    """As :func:`pk_violations`, for whole-number keys without large gaps.

    Each key is one bit of its bucket's bitmap (32,768 keys a bucket); a task sends one bitmap and one row count a
    bucket of a table, not one row a key, and all tables share one shuffle.  A bucket whose bits are fewer than its
    rows holds shared or NULL keys, and only the rows of such buckets are counted by key.  Rows that lie
    together by key (as numbering leaves them) keep a task's buckets few.
    """
    tables = [(df, c) for df, c in tables if c.key]
    keys = reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("t"), F.col(c.key).cast("long").alias("k")) for i, (df, c) in enumerate(tables)])
    keys = keys.withColumn("bucket", F.bitmap_bucket_number("k"))
    marked = keys.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("k"))).alias("bits"))
    suspect = stored(marked.filter(F.col("rows") != F.col("bits")).select(F.col("t").alias("_t"), F.col("bucket").alias("_bucket")))
    names = literal_rows(keys.sparkSession, ["t", "table_name", "column_name"], [(i, c.name, c.key) for i, (_, c) in enumerate(tables)])
    if suspect.isEmpty():
        return names.select("table_name", "column_name", F.lit(0).cast("long").alias("n"))
    bad = (keys.join(suspect, (F.col("t") == F.col("_t")) & F.col("bucket").eqNullSafe(F.col("_bucket")), "left_semi")
           .groupBy("t", "k").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("k").isNull() | (F.col("copies") > 1))
           .groupBy("t").agg(F.sum("copies").alias("n")))
    return names.join(bad, "t", "left").select("table_name", "column_name", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def pk_violations(tables: list[tuple[DataFrame, TableContract]]) -> DataFrame:
    """Rows whose key is NULL or shared with another row."""
    def one(df: DataFrame, c: TableContract) -> DataFrame:
        per_key = df.groupBy(c.key).agg(F.count(F.lit(1)).alias("_copies"))
        bad = F.col(c.key).isNull() | (F.col("_copies") > 1)
        return per_key.agg(F.coalesce(F.sum(F.when(bad, F.col("_copies"))), F.lit(0)).cast("long").alias("n")) \
            .select(F.lit(c.name).alias("table_name"), F.lit(c.key).alias("column_name"), "n")
    return _union([one(df, c) for df, c in tables if c.key])


def fk_violations(child: DataFrame, child_table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL ``child.column`` values with no ``parent.parent_key``.

    One aggregate over the keys of both sides tells, per key, its uses and whether the parent has it (map-side combine: a
    hot key costs one row per task).  No join: a planner that takes a table's compressed bytes for its size broadcasts
    millions of parent keys, built as a hash table in the driver.
    """
    uses = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("_k"), F.lit(1).alias("_uses"), F.lit(False).alias("_known"))
    known = parent.select(F.col(parent_key).alias("_k"), F.lit(0).alias("_uses"), F.lit(True).alias("_known"))
    orphans = uses.unionByName(known).groupBy("_k").agg(F.sum("_uses").alias("_uses"), F.max("_known").alias("_known")).filter(~F.col("_known"))
    return orphans.agg(F.coalesce(F.sum("_uses"), F.lit(0)).cast("long").alias("n")) \
        .select(F.lit(child_table).alias("table_name"), F.lit(column).alias("column_name"), "n")


def violating_rows(df: DataFrame, contract: TableContract, check: str, column: str,
                   parent: DataFrame | None = None, parent_key: str | None = None) -> DataFrame:
    """The rows of ``df`` that break one check on one column (for samples).  No key set is broadcast: its size is not known."""
    c = F.col(column)
    if check == "not_null":
        return df.filter(c.isNull())
    if check == "length":
        return df.filter(F.length(c) > contract.column(column).max_length)
    if check == "numeric":
        p, s = contract.column(column).decimal
        return df.filter(c.isNotNull() & c.try_cast(T.DecimalType(p, s)).isNull())
    if check == "primary_key":
        shared = df.groupBy(column).agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)
        return df.filter(c.isNull()).unionByName(df.join(shared.select(column).hint("merge"), [column], "left_semi"))
    if check == "foreign_key":
        keys = parent.select(F.col(parent_key).alias(column))
        return df.filter(c.isNotNull()).join(keys.hint("merge"), [column], "left_anti")
    raise ValueError(f"unknown check {check!r}")
