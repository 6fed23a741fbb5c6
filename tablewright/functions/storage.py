"""Where intermediate tables go. The cluster names a shared folder; nothing is kept on one machine."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local: dict[str, str] = {}  # application id -> temporary folder, of local sessions without a named one


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="tablewright-", dir="/tmp")
    return _local[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tablewright/{name}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Boosted trees and cut lineages write checkpoints; give them the shared folder if none is set yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partitions and row order are fixed, and survive a lost executor."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
