"""Readers and writers of run records: JSON events, launch plans, metrics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed fields of an event: always present, then optional ones.
REQUIRED = ("ts", "level", "run_type", "run_id", "event", "status")
OPTIONAL = {
    "script": "string", "parent_run_id": "string", "stage": "string", "shard_index": "int", "gpu_id": "string",
    "container_name": "string", "batch_name": "string", "command": "string", "exit_code": "int", "elapsed_sec": "double",
    "error": "string", "reason": "string", "child_run_id": "string",
}
MAPS = ("params", "metrics", "paths")
EVENT_SCHEMA = ", ".join(
    [f"{c} string" for c in REQUIRED] + [f"{c} {t}" for c, t in OPTIONAL.items()] + [f"{c} map<string,string>" for c in MAPS] + ["_corrupt string"])
#: Fixed columns of a launch plan, a table without a header.
PLAN_COLUMNS = ("gpu_id", "idx", "container_name", "batch_name", "data_dir", "session_name", "rc_file", "child_run_id", "log_file", "events_file")


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines; missing keys are null, unreadable lines are kept in _corrupt."""
    return spark.read.schema(EVENT_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def event_json(columns: dict[str, Column]) -> Column:
    """One compact JSON record: nulls and empty texts go, zeros stay."""
    keep = [F.when(c.cast("string") != "", c).alias(k) for k, c in columns.items()]
    return F.to_json(F.struct(*keep), {"ignoreNullFields": "true"})


def append_events(records: DataFrame, path: str) -> None:
    """Appends a column of JSON records as text files."""
    records.write.mode("append").text(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'int' if c == 'idx' else 'string'}" for c in PLAN_COLUMNS)
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def write_plan(plan: DataFrame, path: str) -> None:
    plan.select(*PLAN_COLUMNS).write.mode("append").option("sep", "\t").csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A metrics table by image, written anew; numbers with six places."""
    cols = [F.format_string("%.6f", c).alias(c) if t == "double" else F.col(c) for c, t in metrics.dtypes]
    metrics.select(*cols).sort("image").write.mode("overwrite").option("header", True).csv(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """key=value lines of text; of a key's lines the last counts, others are ignored by the caller."""
    from ..functions.scalars import split_pair

    k, v = split_pair(F.col("value"))
    return spark.read.text(path).select(k.alias("key"), v.alias("value")).where("key is not null")
