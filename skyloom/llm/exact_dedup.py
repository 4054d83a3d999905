"""Exact dedup by content sort, in DataFrame operations only.

Texts are normalised (each run of ASCII white space becomes one space) and
range-partitioned by sampled splitters over (leading bytes, content hash).  The
external sort by (leading bytes, hash, whole content, doc_id) puts equal texts
next to each other; the window over whole contents compares neighbours in full
and keeps the smallest id.  The hash only spreads texts that begin alike, and
bounds what the sampling of splitters sends to the driver.

Hot groups: a counting pass over 64-bit hashes finds contents that hold more rows
than one task should sort (``run_rows``, or 1 / ``hot_share`` of all rows if that is
less).  Each is cut into salted runs of about that many rows, and the heads of the
runs are compared in full once more.  There are at most rows / ``run_rows`` +
``hot_share`` runs, and Catalyst broadcasts their lists only if they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

RUN_ROWS = 100_000
HOT_SHARE = 400


def _normal(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.SPACE, " ")


def _sorted_runs(
    docs: DataFrame, id_col: str, text_col: str, carry: list[str], run_rows: int, hot_share: int, lead: int,
) -> DataFrame:
    """Rows by run: id, norm, h, salt (-1: not hot), at (place in the run), run_id and run_size; and ``carry`` as _c0, _c1, ...

    With ``carry`` the text travels as it is and is normalised again after the exchange.
    """
    norm = _normal(F.col(f"`{text_col}`"))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)],
        norm.alias("norm"))
    counts = rows.groupBy(F.xxhash64("norm").alias("h")).agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    limit = F.greatest(F.lit(200), F.least(F.lit(run_rows), F.floor(F.col("total") / hot_share)))
    hot = C.stored(
        counts.crossJoin(F.broadcast(total))  # a single row
        .where(F.col("n") > limit).select("h", F.ceil(F.col("n") / limit).cast("int").alias("salts")))
    salted = (
        rows.withColumn("h", F.xxhash64("norm")).join(hot, "h", "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"), F.lit(-1)))
        .withColumn("lead", F.substring("norm", 1, lead)).drop("salts")
    )
    if carry:
        salted = salted.drop("norm")
    salted = salted.repartitionByRange(C.n_tasks(docs), "lead", "h", "salt")
    if carry:
        salted = salted.withColumn("norm", _normal(F.col(f"_c{carry.index(text_col)}")))
    run = Window.partitionBy("lead", "h", "salt", "norm")
    sorted_run = run.orderBy(F.col("id").asc_nulls_last())
    out = salted.withColumn("at", F.row_number().over(sorted_run))
    if not carry:
        out = out.withColumn("run_id", F.first("id").over(sorted_run)).withColumn("run_size", F.count("*").over(run))
    return out


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    run_rows: int = RUN_ROWS, hot_share: int = HOT_SHARE, lead: int = 48,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty.  Null ids sort after all others; a group of only
    null ids has a null keep_id.  Of rows that repeat an id and a text just one
    is kept.  Other columns are ignored, whatever their names.  An empty table
    gives an empty result.  A text is compared whole, whatever its length.
    """
    runs = _sorted_runs(docs, id_col, text_col, [], run_rows, hot_share, lead)
    runs = C.stored(runs.select(
        "id", "at", "run_id", "run_size", "salt", F.sha2("norm", 256).alias("sha"),
        F.when((F.col("salt") >= 0) & (F.col("at") == 1), F.col("norm")).alias("head")))
    whole = Window.partitionBy("head")
    heads = C.stored(
        runs.where("head is not null")
        .withColumn("first", F.row_number().over(whole.orderBy(F.col("run_id").asc_nulls_last(), "salt")) == 1)
        .select(
            "sha", "salt", "first",
            F.min("run_id").over(whole).alias("all_id"), F.sum("run_size").over(whole).alias("all_size"),
        )
    )
    return (
        runs.drop("head").join(heads, ["sha", "salt"], "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("salt") >= 0, F.col("all_id")).otherwise(F.col("run_id")).alias("keep_id"),
            F.coalesce("all_size", "run_size").cast("long").alias("group_size"),
            ((F.col("at") == 1) & F.coalesce("first", F.lit(True))).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def distinct_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    run_rows: int = RUN_ROWS, hot_share: int = HOT_SHARE, lead: int = 48,
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_dedup`` keeps: one for each text, that of the smallest id.

    The content sort carries the rows, so texts are exchanged once.  Where an id
    repeats with its text, which of these rows stays is open.
    """
    runs = _sorted_runs(docs, id_col, text_col, docs.columns, run_rows, hot_share, lead)
    own = [f"_c{i}" for i in range(len(docs.columns))]
    first = C.stored(
        runs.where("at = 1").select("id", *own, "salt", F.when(F.col("salt") >= 0, F.col("norm")).alias("head")))
    by_id = Window.partitionBy("head").orderBy(F.col("id").asc_nulls_last(), "salt")
    heads = first.where("salt >= 0").withColumn("at", F.row_number().over(by_id)).where("at = 1")
    out = first.where("salt < 0").select(*own).unionByName(heads.select(*own))
    return out.select(*[F.col(n).alias(c) for n, c in zip(own, docs.columns, strict=True)])
