"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.materialize import stored

__all__ = ["SPACE", "WORD", "ascii_lower", "bounded_batches", "least_hash_sample", "memory_returned", "stored", "table", "word_count"]

# Words are runs of anything but ASCII white space (space, tab, LF, VT, FF, CR).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

ARROW_ROWS, ARROW_ROWS_SETTING = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(run: Callable) -> Callable:
    """``run(spark, ...)`` in a session that hands Python at most ``ARROW_ROWS`` rows at a time.

    Rows here are whole texts or sets, for which Spark's 10,000 take much of an executor's memory, on both sides.  The
    setting stays, since the result is lazy; a session that has a value of its own keeps it.
    """
    @wraps(run)
    def bounded(spark: SparkSession, *rest):
        if spark.conf.get(ARROW_ROWS_SETTING) == "10000":
            spark.conf.set(ARROW_ROWS_SETTING, ARROW_ROWS)
        return run(spark, *rest)

    return bounded


def memory_returned(run: Callable) -> Callable:
    """``run(batches)`` that gives freed memory back to the system at the end of its task.

    Spark's Python workers outlive their tasks, and what one step has used would count beside the next step's.
    """
    @wraps(run)
    def returning(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
            if trim is not None:
                trim(0)

    return returning


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as long (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def least_hash_sample(rows: DataFrame, draw: Column, most: int) -> DataFrame:
    """The at most ``most`` rows of least ``draw`` (a 64-bit hash of the row): a bounded, repeatable sample.

    Rows are first thinned by the hash to about twice as many, so that the last, ordered step sees
    a bounded number of rows however large the input.
    """
    drawn = rows.withColumn("_draw", draw)
    n = rows.count()
    if n > 2 * most:
        drawn = drawn.filter(F.col("_draw") < F.lit(-(1 << 63) + int((1 << 64) * (2 * most / n))).cast("long"))
    return drawn.orderBy("_draw", *[c for c in rows.columns]).limit(most)
