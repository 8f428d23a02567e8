"""Shared scratch tables, used to cut a plan where one result feeds several consumers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors share, as named by the session.

    Only a local session without the setting gets a folder of its own. On a cluster without it there is
    none: a folder on one machine would be lost with it.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return None
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="seasonstar-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    folder = shared_dir(spark)
    if folder is None:
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write the table to the shared folder and read it back.

    The result survives the loss of any executor, is not recomputed per consumer, and carries its real
    size, so the planner can decide on broadcasts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
