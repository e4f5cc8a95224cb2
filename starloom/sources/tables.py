"""Column-contracted Parquet scans of the input tables.

Every scan names the columns it needs, so the Parquet reader only decodes those
(``ReadSchema`` in the plan) and filters written later reach the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column name of the per-line lineage value carried by line-grained frames.
LINE_COL = "_line"


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def read_table(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(table_path(root, name)).select(*columns)


def line_salt(parquet: bool = True) -> Column:
    """A deterministic per-row value taken at a file scan.

    For Parquet it is a hash of the file path and the row's position in that
    file; other formats have no row position in their metadata, and use the
    row's position within its file split (taken directly at the scan, where
    a retried task re-reads the same split in the same order).  It never
    reaches an output table; it only breaks ties between otherwise identical
    rows when a global order is cut into ranges, so a run of equal rows can
    spread over many partitions.
    """
    if parquet:
        return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return F.monotonically_increasing_id()


def read_lines(spark: SparkSession, root: str, name: str, columns: list[str], keep_line: bool = True) -> DataFrame:
    """Scan a line-grained table; with ``keep_line`` also the lineage value as ``_line``."""
    lineage = [line_salt().alias(LINE_COL)] if keep_line else []
    return spark.read.parquet(table_path(root, name)).select(*columns, *lineage)


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few literal rows (numbers are longs), generated in the JVM."""
    structs = [F.struct(*[(F.lit(v).cast("long") if isinstance(v, int) else F.lit(v)).alias(n) for n, v in zip(names, row)])
               for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("_row")).select("_row.*")


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file with a header row; every column a string named by the header.

    Quotes follow RFC 4180 (a quote inside a quoted field is doubled).  A record with
    more or fewer fields than the header fails the read.
    """
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "FAILFAST").csv(path))


def zero_pad(value: Column, width: int) -> Column:
    """An integer as text, zero-padded to ``width`` characters like ``printf('%0<width>d')``.

    Never truncates: a value with more digits keeps all of them.  A negative
    value keeps its sign in front of the zeros (-5 at width 6 is ``-00005``).
    """
    digits = F.abs(value).cast("string")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    pad_to = F.greatest(F.length(digits), F.lit(width) - F.length(sign))
    return F.concat(sign, F.lpad(digits, pad_to, F.lit("0")))
