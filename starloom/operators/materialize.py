"""Cut lineage by writing a frame to the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.commit_log import remove_folder
from starloom.session import ensure_checkpoint_dir

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folder: ContextVar[str | None] = ContextVar("scratch folder", default=None)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files as they end.

    Later steps read what was written.  Otherwise these files lie on the executors' disks until the driver happens to
    collect garbage, and a job of many steps holds the shuffles of all of them.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What :func:`stored` writes inside the block goes below one folder, which is removed at its end.

    For jobs that have written their results by then.
    """
    path = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)
        remove_folder(spark, path)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint of ``df`` (serialized rows), for small or short-lived frames.

    The data is written once to ``spark.checkpoint.dir``; later reads do not
    recompute the plan, so a lost executor costs a re-read, not a re-run of
    every upstream join, and values fixed at write time (partition ids, row
    positions) stay fixed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame's plan has the setting of when it was made


def _own_path(spark: SparkSession) -> str:
    return f"{_folder.get() or ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage like :func:`materialize`, but readers decode only the columns they
    name and filters reach the scan.  ``compression`` is a Parquet codec in place of the session's.
    """
    path = _own_path(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, column: str, compression: str) -> DataFrame:
    """As :func:`stored`, in as many buckets of ``column`` as the session shuffles to.

    A join or aggregate by ``column`` finds the rows where they lie, without an exchange; where ``df`` is dealt by
    ``column`` (it ends in a join by it), writing needs none either.  The catalog's entry goes once it is resolved; the
    files stay, as those of :func:`stored` do.
    """
    spark, name, path = df.sparkSession, f"stored_{uuid.uuid4().hex}", _own_path(df.sparkSession)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, column).write.format("parquet").option("compression", compression).option("path", path)
     .bucketBy(buckets, column).saveAsTable(name))
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows
