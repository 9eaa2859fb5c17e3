"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators are designed for.  AQE splits hot join
# partitions by measured size; forcing it accepts one more exchange rather than
# leaving a hot key in a single task when two joins share a partitioning.  Stream
# state with one entry per key lives in RocksDB, not on the heap.  Whole texts and pages
# go to Python in batches of few rows, which bounds what a worker and its JVM hold twice.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "kontor", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SQL_SETTINGS | {"spark.ui.enabled": "false"}
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else has built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Without that setting a local session uses a folder of its warehouse, and a cluster
    raises: no executor could read a path of the driver's machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch")
        current = context.getCheckpointDir()
    return os.path.dirname(current.rstrip("/"))


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/kontor-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written there, once its results are stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
