"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this library relies on: UTC session zone (all
# zone handling is explicit), AQE for runtime coalescing / skew splitting.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows dealt by order number meet on (order, line) without being dealt again
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "truetally") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("TT_DRIVER_MEMORY", "16g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings the library needs on an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs inside drop their shuffle files when they end: for writes whose plans no later job reads again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, kept)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read ``spark.checkpoint.dir`` from the session; only when it is unset (local
    tests) a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) for cluster runs")
        # local tests only: the setting is static, so register a scratch folder with the context
        d = tempfile.mkdtemp(prefix="truetally-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(d)
    return d
