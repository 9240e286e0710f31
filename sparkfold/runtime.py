"""Scratch space shared by the whole cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkfold-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
