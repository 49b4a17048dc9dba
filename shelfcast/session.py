"""Session construction and the shared scratch location.

On a cluster the scratch location is whatever the deployment names in
``spark.checkpoint.dir`` (a shared, fault-tolerant file system).  Only when that
setting is absent (local tests, the bench) do we create one of our own.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfcast") -> SparkSession:
    """A session with this library's settings.  Master, memory and shuffle partitions are
    the cluster's own: they are set only for an explicit local run, or where neither the
    caller nor a submit names a master (then the run is local)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    submitted = "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or os.environ.get("SPARK_MASTER")
    if master is None and not submitted and SparkSession.getActiveSession() is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master and master.startswith("local"):
        cores = "".join(c for c in master if c.isdigit()) or str(os.cpu_count())
        builder = (builder.master(master)
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cores)))
                   .config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g")))
    else:
        builder = builder.master(master) if master else builder
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    # Unset, in one process (tests, local bench): our own.
    local = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's files."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/shelfcast-{name}-{uuid.uuid4().hex[:12]}"
