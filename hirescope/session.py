"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    # local mode: the executors live in the driver JVM, so this is their heap
    "spark.driver.memory": "16g",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture costs several JVM round trips per column function
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = "*", app: str = "hirescope", **extra: str) -> SparkSession:
    """Local session used by tests and the benchmark (never on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; a
    cluster session without it is refused, because executors would write to
    their own disks.  Only a local session gets a scratch folder of its own.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="hirescope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
