"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``: so the result of a stage must be
written before the next is called.  All but the last return the columns of
``documents``; decisions need doc_id, text and source, and any other column stays.
"""

from __future__ import annotations

import contextvars
import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, common, exact_dedup, minhash, mixing, quality


#: Work tables of the stage that this thread of control called last: runs in other threads have their own.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("_made", default=None)
_NEEDED = ("doc_id", "text", "source")


def _stage(decide: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage from a function of the documents.

    Its ``docs`` are the written result of the stage before, whose work tables are
    spent: they are deleted.  Columns that the stage doesn't need are renamed while it
    works, so their names can't clash with those of an operator.
    """
    @functools.wraps(decide)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.delete(spark, _made.get() or [])
        made: list[str] = []
        _made.set(made)
        names = {c if c in _NEEDED else f"column_{i}": c for i, c in enumerate(docs.columns)}
        with common.noted(made):
            out = decide(docs.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()]))
        return out.select(*[F.col(n).alias(c) for n, c in names.items()]) if set(names) <= set(out.columns) else out

    return run


@_stage
def quality_rules(docs: DataFrame) -> DataFrame:
    """Documents that fail a base rule, or whose host is rejected, go.

    Null and blank texts fail (no words); a null source is a host of its own; rows that
    repeat are judged one by one; an empty table stays empty.
    """
    return quality.quality(docs, text_of_failed=False).where("kept")


@_stage
def exact(docs: DataFrame) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays, once if it is repeated.

    Null texts are equal to empty ones; null ids come after all others.
    """
    return exact_dedup.distinct_texts(docs)


@_stage
def near(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies stays; five words, similarity 0.8.

    Texts without words stay.  Rows that share an id count as one document and stay or
    go together.  Rows without an id are told apart by their texts, and stay only where no
    row with an id is in their group.
    """
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))))
    kept = minhash.near_dedup(keyed, id_col="_key", k=5, percent=80).where("kept").select("_key").distinct()
    return keyed.join(kept, "_key", "left_semi").drop("_key")


@_stage
def mixed(docs: DataFrame) -> DataFrame:
    """Documents by training position, once for each time that the mix takes them.

    A null text has no words and a null source is a source of its own, the last;
    rows that repeat are taken one by one.
    """
    return mixing.mix(docs).drop("position")


@_stage
def encoded(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes, for each row; null texts have no tokens."""
    out = bpe.encode_decode(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

#: SQL expresses neither the near duplicates nor the BPE; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = f"{common.work_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        if i:
            common.delete(spark, [f"{base}/{i - 1}"])
    common.delete(spark, _made.get() or [])
    return docs
