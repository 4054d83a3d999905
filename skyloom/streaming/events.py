"""Run events as a stream.

The file source tracks files, not offsets in them: rows appended to a file that was
read already are never seen.  Writers therefore rotate: each append is a new file,
as ``skyloom.sources.records.append_events`` writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.records import EVENT_SCHEMA


def event_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Events with ``at``, their time as a timestamp; unreadable lines have a null time."""
    rows = spark.readStream.schema(EVENT_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").option(
        "maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.withColumn("at", F.try_to_timestamp("ts", F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def stage_windows(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts and failures by stage and window of event time; events later than ``late`` are dropped by the watermark."""
    return (
        events.where("at is not null").withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "stage")
        .agg(F.count("*").alias("n"), F.count_if(F.col("status") == "failure").alias("n_failures"))
        .select(F.col("w.start").alias("start"), "stage", "n", "n_failures")
    )


def write_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Processes all that is there to Parquet, exactly once, and stops."""
    return df.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
