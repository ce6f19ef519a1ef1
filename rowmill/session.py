"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every expression costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 512 * 1024 * 1024
MOST_PARTITIONS = 100_000


def size_settings(input_bytes: int) -> dict[str, str]:
    """Shuffle partitions and read splits for an input of this size.

    A shuffle partition of half a gigabyte sorts in an executor's memory. Adaptive execution merges
    what turns out smaller, so the number may be generous, up to what a shuffle can keep track of.
    """
    partitions = min(max(input_bytes // PARTITION_BYTES, 200), MOST_PARTITIONS)
    settings = {"spark.sql.shuffle.partitions": str(partitions)}
    if input_bytes > MOST_PARTITIONS * PARTITION_BYTES // 4:
        settings["spark.sql.files.maxPartitionBytes"] = str(PARTITION_BYTES)
    return settings


def build_session(app: str = "rowmill", master: str | None = None, input_bytes: int | None = None,
                  **settings: str) -> SparkSession:
    """A session with the library's settings; ``master`` is left to spark-submit on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    sized = size_settings(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def steady_splits(spark: SparkSession) -> None:
    """Let every read of a file cut it alike, also while executors come and go.

    Spark derives the size of splits from the cores it has at the time; a set number replaces that.
    """
    name = "spark.sql.leafNodeDefaultParallelism"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, spark.sparkContext.defaultParallelism)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: that of ``spark.checkpoint.dir``, else the one set on the context.

    A folder of our own is made only in local mode, where there are no other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="rowmill-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_folder(spark)}/rowmill/{label}-{uuid.uuid4().hex}"


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Let ``checkpoint()`` write to the shared folder; a folder set on the context is kept."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
