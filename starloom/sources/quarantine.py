"""Staging lines from CSV that may be damaged: good lines load, bad ones are set aside with their reasons.

``read_staging`` fails on the first bad record.  Here the file is read permissively: a record of another width than the
header is kept as text in a corrupt-record column, and each value that is not of its column's type is named.  The
file is parsed once, into a columnar copy from which both tables are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.materialize import stored
from starloom.sources.staging import STAGING_SCHEMA
from starloom.sources.tables import LINE_COL, line_salt

CORRUPT = "_corrupt_record"
WIDTH = "record width"


@dataclass(frozen=True)
class Quarantine:
    """``good``: staging lines under the contract.  ``bad``: (record, reasons), the record as text or, where
    its width is right, as JSON of its columns."""

    good: DataFrame
    bad: DataFrame

    def reasons(self) -> DataFrame:
        """(reason, n): records by reason; one with several counts under each."""
        return self.bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def read_staging_quarantined(spark: SparkSession, path: str, header: list[str] | None = None, keep_line: bool = False) -> Quarantine:
    """Read a CSV staging export with a header, or one without whose columns ``header`` names.

    A column missing from the header fails; records do not.
    """
    reader = spark.read.option("header", header is None).option("quote", '"').option("escape", '"')
    header = reader.csv(path).columns if header is None else header
    missing = [f.name for f in STAGING_SCHEMA.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    raw = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    bound = [F.col(f.name).try_cast(f.dataType).alias(f"to_{f.name}") for f in STAGING_SCHEMA.fields]
    # a value that has text, but no value of its type
    misfits = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
               for f in STAGING_SCHEMA.fields if not isinstance(f.dataType, T.StringType)]
    reasons = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(WIDTH))).otherwise(F.array_compact(F.array(*misfits)))
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*header)))
    parsed = stored(raw.select(*bound, reasons.alias("reasons"), F.when(F.size(reasons) > 0, record).alias("record"), line_salt(parquet=False).alias(LINE_COL)), "zstd")
    good = parsed.filter(F.size("reasons") == 0).select(
        *[F.col(f"to_{f.name}").alias(f.name) for f in STAGING_SCHEMA.fields], *([LINE_COL] if keep_line else []))
    return Quarantine(good, parsed.filter(F.size("reasons") > 0).select("record", "reasons"))
