"""Session settings, the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rillmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC. Master, memory and shuffle sizes are left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        # session windows of a busy user are merged before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # recording the Python line of every column call makes building wide plans several times slower
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(shuffle_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle width for a job that shuffles about ``shuffle_bytes``.

    Adaptive execution merges partitions that turn out small but does not add
    any, so a large job must start wide enough for its partitions to fit.
    """
    return {"spark.sql.shuffle.partitions": str(max(200, -(-shuffle_bytes // partition_bytes)))}


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables that all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made
    only where that setting is missing and the session runs on one machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="rillmark-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder, until ``clear_scratch``."""
    path = os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch paths that this driver has handed out; call it when no frame that reads them is needed any more."""
    paths = [_scratch.pop() for _ in range(len(_scratch))]
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
