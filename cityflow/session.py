"""Session settings the jobs rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Local wall-clock columns are stored as plain timestamps, so the session zone
# must be UTC; the rest lets Spark re-plan skewed or tiny shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # keeps streaming state on disk, where a day of keys does not press on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(
    app: str = "cityflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create a session. On a cluster leave `shuffle_partitions` generous: AQE
    merges small partitions afterwards but cannot split a hash partition that
    feeds an aggregate."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # recording the Python call site of every column costs more than building the plan
    defaults = {**RUNTIME_CONF, "spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**defaults, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under `spark.checkpoint.dir`, which every executor can reach.

    A machine-local folder is only taken where the setting is absent and the
    whole application runs in one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="cityflow-")
    return f"{root.rstrip('/')}/cityflow/{label}-{uuid.uuid4().hex}"
