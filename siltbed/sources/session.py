"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_checkpoints(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without one gets
    a fresh folder; on a cluster a machine's own disk would be lost with the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="siltbed-checkpoint-"))
    return context.getCheckpointDir()


def staging_path(spark: SparkSession) -> str:
    """A new path in the checkpoint folder."""
    return f"{use_checkpoints(spark)}/staged-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate table once and read it back.

    For a result that several later passes read: its plan runs once, lost executors cost no
    recomputation, and being parquet it still offers column pruning and a known size.
    """
    path = staging_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
