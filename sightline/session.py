"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str = "*", partitions: int = 8, app: str = "sightline") -> SparkSession:
    """A session for tests and the bench.  On a cluster, pass the cluster's own session."""
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SIGHTLINE_DRIVER_MEMORY", "12g"))
        .config("spark.local.dir", scratch)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master, where the driver's disk is every executor's disk, falls back to a
    temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Mark a narrow lookup table for broadcast if it has at most ``rows`` rows.

    The table is written to the shared folder and counted first, so its size is known; a larger one
    is joined by a shuffle.  Facts then need no exchange on a key of a few values.
    """
    df = pin(df)
    return F.broadcast(df) if df.count() <= rows else df


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back.

    Used where two branches must see exactly the same partition numbers, and to cut the
    lineage of loops.  The copy is on shared storage, so it survives lost executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()
