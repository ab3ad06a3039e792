"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split hot join keys even where the split costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sides below this measured size are broadcast, all others are shuffled
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # tables bucketed by match id, within folders by source, join on (source, match id) in place
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # wide projections: methods beyond the JIT limit run interpreted, so let Spark split them
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a task keeps one open file per folder, up to this many, instead of sorting its rows by folder
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


# The test tables are single files of one row group, read by one task each. Joins
# that shuffle spread the work over all cores; small dimensions are still broadcast.
LOCAL = {
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """A session for tests and the local bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("scrimtally")
    conf = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **LOCAL,
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# settings that may be changed while a session runs
_RUNTIME = (
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
    "spark.sql.requireAllClusterKeysForCoPartition",
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.maxConcurrentOutputFileWriters",
)


def tune(spark: SparkSession) -> None:
    """Apply the run-time settings to a session that does not set them itself."""
    given = spark.sparkContext.getConf()
    for key in _RUNTIME:
        if not given.contains(key):
            spark.conf.set(key, SETTINGS[key])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. A local temporary folder
    is used only where the session names none and runs on this machine alone.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
