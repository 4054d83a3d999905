"""Lineage cuts in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _own_folder(spark: SparkSession) -> str:
    """For local mode (tests) only: elsewhere executors don't see it."""
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="work-")


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or _own_folder(spark)).rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in spark.checkpoint.dir; only where that is unset, in local mode, in an own folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(_own_folder(spark))
    return df.checkpoint()
