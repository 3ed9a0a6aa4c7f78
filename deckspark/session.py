"""Spark session and shared scratch-space helpers.

Everything that needs to cut lineage or stage a file uses the folder the
cluster names in ``spark.checkpoint.dir``; only a local session without that
setting uses a folder of its machine.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CHECKPOINTS = "/tmp/checkpoints"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # State of custom stream processors has several column families.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Broadcast only what the planner has measured to be small.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "deckspark", event_log_dir: str | None = None) -> SparkSession:
    """A local session with the library's defaults.  ``event_log_dir``
    turns on Spark's event log (stage and task timings) in that folder."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names.  Where it is
    unset, a local session uses a folder of the machine; a cluster session
    fails, since its executors would not see such a folder."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = LOCAL_CHECKPOINTS
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, name: str = "lineage", codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table under the shared checkpoint
    folder and continue from it.  The lineage of the result is one file
    scan, so a lost executor re-reads files instead of recomputing the
    history; parquet keeps the write columnar and lets later reads prune
    columns (faster than an RDD checkpoint of serialized rows).  ``codec``
    compresses the table other than the session does."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
