"""Append rows to a table whose serial key continues from the rows already there.

``INSERT INTO t(cols) VALUES ...`` fills a serial key with the next values of
a sequence.  Here the sequence is a log beside the rows (``<table>/_log``): an append claims the next
version, which names the range of keys it takes, and then writes its rows to a folder of that version.
Of two appends at once one claims first and the other continues after its keys; keys are never given twice.  As with a
database's sequence, an append that fails after its claim leaves a gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starloom.operators.commit_log import CommitLog
from starloom.operators.dense_ids import Numbered, with_dense_ids


def next_key(existing: DataFrame | None, key_col: str, first: int = 1) -> int:
    """One past the largest key of ``existing`` (``first`` when empty); one
    global max aggregate, a single value reaches the driver."""
    if existing is None:
        return first
    top = existing.agg(F.max(key_col).alias("m")).first()["m"]
    return first if top is None else int(top) + 1


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


LOAD = "load"  # partition column: the version that wrote a row


def append_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/_log")


def claim_keys(spark: SparkSession, path: str, key_col: str, rows: int, first: int = 1) -> tuple[int, int]:
    """(version, first key) of an append of ``rows`` rows to the table at ``path``."""
    def entry(number: int, before: dict | None) -> dict:
        start = before["next"] if before else next_key(read_if_exists(spark, path), key_col, first)
        return {"first": start, "next": start + rows}

    number, claimed = append_log(spark, path).commit(entry)
    return number, claimed["first"]


def append_with_serial(spark: SparkSession, path: str, rows: DataFrame, key_col: str, order_by: list[str],
                       tiebreak: list[str] | None = None, first: int = 1) -> Numbered:
    """Append ``rows`` to the Parquet table at ``path`` with continuing keys.

    The rows are numbered from 0 first, so their count is known when the keys are claimed.  Each append has a folder
    of its own, ``load=<version>``, so appends at once do not meet in a file committer either.
    """
    numbered = with_dense_ids(rows, order_by, key_col, start=0, tiebreak=tiebreak)
    number, start = claim_keys(spark, path, key_col, numbered.rows, first)
    keyed = numbered.df.withColumn(key_col, F.col(key_col) + F.lit(start).cast("long"))
    keyed.write.parquet(f"{path}/{LOAD}={number}")
    return Numbered(keyed, numbered.rows)
