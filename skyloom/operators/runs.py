"""Run accounting on events: totals, durations, failures, outcomes, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failures(events: DataFrame, *columns: str) -> DataFrame:
    return events.where("status = 'failure'").select(*columns)


def totals(events: DataFrame) -> DataFrame:
    """One row per run: partial sums before the shuffle."""
    return events.groupBy("run_id").agg(
        F.count("*").alias("n_events"), F.count_if(F.col("status") == "failure").alias("n_failures"),
        F.round(F.sum("elapsed_sec"), 4).alias("elapsed_sec"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def funnel(events: DataFrame, stages: list[str]) -> DataFrame:
    """One row of counts, a column a stage; stages without rows are 0."""
    return events.agg(*[F.count_if(F.col("stage") == s).alias(f"count_{s}") for s in stages])


def durations(events: DataFrame) -> DataFrame:
    """Seconds from the first to the last event of each stage of a run."""
    return events.groupBy("run_id", "stage").agg(
        F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("elapsed"), F.count("*").alias("n"))


def first_failure(events: DataFrame) -> DataFrame:
    """The first failing event of each run; later ones don't change it."""
    bad = events.where("status = 'failure'")
    return bad.groupBy("run_id").agg(F.min_by(F.struct("event_id", "stage", "elapsed_sec"), F.struct("ts", "event_id")).alias("f")).select(
        "run_id", "f.event_id", "f.stage", "f.elapsed_sec")


def outcomes(plan: DataFrame, codes: DataFrame, made: DataFrame) -> DataFrame:
    """``plan`` (shard) with its return code and counts; no code is 'missing', and only '0' is a success."""
    rc = F.coalesce(F.regexp_replace("rc", r"\s", ""), F.lit("missing"))
    return (
        plan.join(codes, "shard", "left").join(made, "shard", "left")
        .select(*plan.columns, rc.alias("rc"), F.coalesce("n_out", F.lit(0)).alias("n_out"))
        .withColumn("status", F.when(F.col("rc") == "0", "success").otherwise("failure"))
        .withColumn("exit_code", F.when(F.col("rc").rlike("^[0-9]+$"), F.col("rc").try_cast("int")))
    )


def gated(stages: DataFrame, stop_after: str) -> DataFrame:
    """Stages (run, ord, stage) up to ``stop_after`` run, later ones are skipped; without it all run."""
    stop = stages.where(F.col("stage") == stop_after).groupBy("run").agg(F.min("ord").alias("_stop"))
    return stages.join(stop, "run", "left").withColumn(
        "action", F.when(F.col("_stop").isNull() | (F.col("ord") <= F.col("_stop")), "run").otherwise("skip")).drop("_stop")


def run_id(key):
    """A short id of a run, from what names it."""
    return F.concat(F.lit("run_"), F.substring(F.md5(key), 1, 12))
