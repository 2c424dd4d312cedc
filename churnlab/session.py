"""Session and shared-storage helpers.

Everything that is written between stages (checkpoints, round-trip tables,
landing folders for batches and streams) goes below the folder the cluster
names in ``spark.checkpoint.dir``.  A local folder is only created when that
setting is absent and the master is local, as in tests and on a laptop; on a
cluster the setting must be there.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "churnlab", cpus: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings used by tests and the bench."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    parts = shuffle_partitions or int(os.environ.get("CHURNLAB_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CHURNLAB_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="churnlab-ckpt-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/churnlab-work/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a small or often-read table below the shared folder and read it
    back: computed once, lineage cut, and its true size known to the planner
    (so that Spark's own size check decides about broadcasting it)."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
