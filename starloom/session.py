"""Session construction and the shared checkpoint folder.

Lineage is cut with reliable ``checkpoint()`` into the folder named by
``spark.checkpoint.dir``.  On a cluster that folder must be shared storage and is
set by whoever launches the job; only a local session (tests, bench) may fall
back to a fresh temporary folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the job relies on: adaptive execution coalesces small shuffle
# partitions, splits skewed join partitions and turns joins whose built side
# proves small at run time into broadcast joins.  The planner's own broadcast
# choice, made from file-size estimates before anything runs, is switched
# off: broadcasts come from measured shuffle sizes (adaptive) or from
# explicit hints placed after an exact row count.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of frames that are no longer referenced are removed;
    # checkpoints (serialized rows) are compressed on their way to shared storage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session configuration.

    A folder is invented only for a local session where none is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder on shared storage "
            "(every executor must be able to read what another one wrote)")
    return sc.getCheckpointDir()
