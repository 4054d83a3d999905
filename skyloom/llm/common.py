"""What the operators share: text primitives, work tables, global ranks.

Work tables are Parquet folders below ``spark.checkpoint.dir``, which all
executors share; they cut lineage, survive lost executors, and are read back
by Spark's own readers only.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space; words are what lies between.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Input bytes that one reduce task of the operators should get.
TASK_BYTES = 16 << 20

_own_dir: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set, an own one in local mode (tests), and an error elsewhere."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="work-"))
    return _own_dir[0]


#: The list that notes the work tables made in this thread of control.
_notes: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("_notes", default=None)


@contextlib.contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Within it, the folders of new work tables are added to ``paths``."""
    before = _notes.set(paths)
    try:
        yield
    finally:
        _notes.reset(before)


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """``df`` written as a work table and read back."""
    spark = df.sparkSession
    path = f"{work_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    if (notes := _notes.get()) is not None:
        notes.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete the folders of work tables that nothing reads any more, and empty the list."""
    sc = spark.sparkContext
    while paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files below ``df``; inputs of unknown size (rows from the driver) count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def n_tasks(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Partitions for work on ``df``: by its size, at least the session's setting."""
    spark = df.sparkSession
    by_size = min(input_bytes(df) // task_bytes, 200_000)
    return int(max(by_size, int(spark.conf.get("spark.sql.shuffle.partitions")), 1))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text without building them: gaps between trimmed words plus one."""
    flat = F.trim(F.regexp_replace(text, SPACE, " "))
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """``df`` with each row's place (from 0) in the whole order, as a work table.

    Rows are range-partitioned by sampled splitters and sorted in their
    partitions; only one count per partition meets in one place.
    """
    n = n_tasks(df, 4 << 20)
    local = stored(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    starts = (
        local.groupBy("_part").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
        .select("_part", "_start")
    )
    # One row per partition of the sort: bounded by their number.
    return (
        local.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_part", "_at", "_start")
    )
