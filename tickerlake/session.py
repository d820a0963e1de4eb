"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (date keys must not shift),
# ANSI arithmetic (Spark 4 default, kept explicit), adaptive execution so joins
# whose build side turns out small become broadcasts at run time and skewed
# shuffle partitions get split.
# Windows and joins of a series may share a partitioning by its key alone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
}


def get_spark(
    app: str = "tickerlake",
    cores: int | str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's
    session and only apply ``BASE_CONF``."""
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from the session (``spark.checkpoint.dir`` or an already
    set checkpoint directory).  Only when neither is set and the session runs
    in one process (``local[...]``) a fresh folder is created and registered;
    on a cluster a machine-local folder would be another one on each executor,
    so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all executors share"
        )
    local = tempfile.mkdtemp(prefix="tickerlake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tables", *parts, uuid.uuid4().hex])
