"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants. Executors, memory and the master come from
# spark-submit or spark-defaults, never from here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many small partitions before the shuffle; AQE merges what is too small,
    # but cannot split what an aggregate reads.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # Shuffle-written tables (the cleaned ones) get files of about this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_session(app_name: str, **extra: str) -> SparkSession:
    """Session with the defaults above; keyword arguments are Spark settings
    with `__` for `.` (``spark__sql__shuffle__partitions="4000"``)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares (`spark.checkpoint.dir`). Where none is
    configured a local master gets a temporary one; a cluster is an error, as
    its machines would each see a folder of their own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="flowlake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
