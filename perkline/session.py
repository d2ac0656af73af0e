"""Spark session and shared-storage helpers.

Every job in the package assumes:

* session time zone pinned to UTC (instants are stored as UTC wall time,
  local days are derived explicitly with ``convert_timezone``);
* ANSI mode on, so a malformed parameter cast fails loudly instead of
  silently turning into NULL;
* adaptive query execution on, so join strategy, partition coalescing and
  skewed-partition splitting are re-planned from runtime statistics.

Scratch data (staged table versions, exported files, checkpoints) always goes
under ``spark.checkpoint.dir``: on a cluster that is the shared folder the
platform configured.  A private folder is created only for a local session
without the setting; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "perkline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs rely on.

    ``master``/``shuffle_partitions`` are only meant for local runs and
    tests; on a cluster the submit configuration wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs depend on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for staged data: ``spark.checkpoint.dir`` of the session.

    Only a local session may have none: a private folder is created and
    registered then.  On a cluster each executor would write to its own disk,
    so a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="perkline-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "staged", f"{name}-{uuid.uuid4().hex}")


def materialise(df, name: str):
    """Write ``df`` once as Parquet to a fresh path under the shared
    checkpoint folder and return the scan of it.

    Cuts the lineage like ``checkpoint()`` (the files survive executor
    loss and live in the cluster's shared folder) but computes the plan a
    single time: ``DataFrame.checkpoint()`` evaluates it once to count and
    once more to write unless the frame was persisted first.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
