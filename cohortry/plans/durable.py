"""Cutting lineage in a way that survives losing executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Paths handed out by ``scratch_path``, per application.
_scratch: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    Only a session in one JVM without that setting gets a temporary folder, which
    goes when the program ends; on a cluster, also one of local processes, a
    machine-local folder would be lost with its executor.  A ``file:`` folder is
    taken as named: it may be a mount that all machines share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cohortry-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``release_scratch`` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def is_scratch(spark: SparkSession, path: str) -> bool:
    """Whether a scratch path was handed out and not released since."""
    return path in _scratch.get(spark.sparkContext.applicationId, ())


def release_scratch(spark: SparkSession) -> int:
    """Remove what this application wrote to scratch paths; returns their number.

    Frames that still read from them become unusable, so call it after the last
    result is written.
    """
    context = spark.sparkContext
    paths = _scratch.pop(context.applicationId, [])
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


def store(frame: DataFrame) -> tuple[DataFrame, int]:
    """Write the rows below the shared folder; the stored rows and their number.

    Smaller than a checkpoint and read column by column, but which partition holds a
    row is not fixed.
    """
    path, counted = scratch_path(frame.sparkSession, "stored"), Observation()
    frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), counted.get["rows"]


def hold(frame: DataFrame, most: int) -> DataFrame:
    """The rows of a result that has at most ``most``, fixed at this moment.

    They pass through the driver, so ``most`` must be a small number by design.
    """
    rows = frame.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return frame.sparkSession.createDataFrame(rows, frame.schema)


def freeze(frame: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows, and which partition holds them, are fixed."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)
