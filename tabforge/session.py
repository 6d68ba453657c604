"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the shared ``spark.checkpoint.dir`` that the
cluster configuration names; it is only created here when the session has none
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tabforge",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Local or cluster session with the settings every operator assumes.

    AQE stays on: it coalesces small shuffle partitions, converts joins whose
    measured side is small into broadcast joins at run time and splits skewed
    join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    cpus = os.cpu_count() or 8
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # Local runs: one shuffle partition per core.  On a cluster the configured value
    # stays (size it so a partition holds ~128-256 MB of shuffle data; AQE coalesces
    # the small ones and splits skewed ones).
    if shuffle_partitions or (master or "").startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = (sc.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None))
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the session's checkpoint folder (cuts lineage;
    survives executor loss).  The folder is the cluster's ``spark.checkpoint.dir``;
    a local one is created only when none is configured."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
