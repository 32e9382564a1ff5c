"""Results that outlive an executor: reliable checkpoints and scratch tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster
    a machine-local folder would be lost with the machine, so that case is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active is not None:
        return active
    if re.fullmatch(r"local(\[.*\])?", context.master) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder for a table that one query writes."""
    return f"{shared_folder(spark).rstrip('/')}/tidewatch/{name}-{uuid.uuid4().hex}"
