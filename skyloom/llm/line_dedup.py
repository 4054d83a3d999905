"""Reversible line dedup: exact reference counts, with sharded cuckoo filters before them.

The state is a table of postings (key, doc_id, n): insertions add to it, document
deletions take away, and nothing else is kept, so every step can be undone.  Its
counts by key (documents, largest id) are exact.  A cuckoo filter per shard holds
the keys whose count has reached ``min_docs``; a batch probes the filters first and
only lines that may be shared go to the exact table.  The filters have a fixed
budget (``FILTER_BYTES``), which bounds what is broadcast; a shard beyond it
answers "maybe", and its lines all go to the exact table, until deletions make room
for it: then it is built again from the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .cuckoo import SLOTS, Filters, Shard

MIN_CHARS = 40
MIN_DOCS = 5
N_SHARDS = 64
#: What all shards take at most; they take about 3 bytes a shared key, so this holds some 40 million.
FILTER_BYTES = 128 << 20
#: Share of its slots that a shard is filled to.
LOAD = 0.95
_BLANK = b" \t\n\r\x0b\x0c"


class Index(NamedTuple):
    """What is kept between runs: postings (key, id, n), filters (shard, data) and the buckets of a shard."""

    state: DataFrame
    filters: DataFrame
    n_buckets: int


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit digest of a line's key; None where the key is short."""
    key = line.strip(_BLANK)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _keys(min_chars: int, filters=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = filters.value.maybe if filters is not None else None
        for b in batches:
            owner, keys = [], []
            for i, t in zip(b["id"].to_pylist(), b["text"].to_pylist(), strict=True):
                own = {line_key(x, min_chars) for x in t.encode().split(b"\n")} if t else set()
                own.discard(None)
                owner += [i] * len(own)
                keys += sorted(own)
            out = pa.record_batch([pa.array(owner, pa.int64()), pa.array(keys, pa.binary())], names=["id", "key"])
            yield out.filter(pa.array(probe(b"".join(keys)))) if probe and keys else out

    return run


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, id, n = 1) for each long key of each document that has an id."""
    rows = docs.where("id is not null").mapInArrow(_keys(min_chars), "id long, key binary")
    return rows.select("key", "id", F.lit(1).cast("long").alias("n"))


def update(
    state: DataFrame | None, inserted: DataFrame | None = None, deleted: DataFrame | None = None, min_chars: int = MIN_CHARS,
) -> DataFrame:
    """The postings after inserting and deleting documents (id, text); pairs whose sum is 0 are gone."""
    parts = [state] if state is not None else []
    if inserted is not None:
        parts.append(postings(inserted, min_chars))
    if deleted is not None:
        parts.append(postings(deleted, min_chars).withColumn("n", -F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key", "id").agg(F.sum("n").alias("n")).where("n > 0")


def counts(state: DataFrame) -> DataFrame:
    """(key, n_docs, last): exact reference counts, and the largest id."""
    return state.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))


def _shard(n_shards: int):
    # the digest's first eight bytes as a little-endian number, modulo a power of two: its first byte
    return F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("int") % n_shards


def _filled(n_buckets: int, keys: list[bytes]) -> Shard:
    shard = Shard(n_buckets)
    if len(keys) > n_buckets * SLOTS * LOAD:
        shard.saturated = True
    else:
        shard.insert(b"".join(keys))
    return shard


def _row(key: tuple, shard: Shard) -> pa.Table:
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([shard.to_bytes()], pa.binary())})


def _build(n_buckets: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return _row(key, _filled(n_buckets, rows["key"].to_pylist()))

    return run


def buckets(n_shared: int, n_shards: int = N_SHARDS) -> int:
    """Buckets of a shard for so many keys, within the budget."""
    need = max(16, int(n_shared / n_shards * 1.5 / SLOTS))
    return min(1 << need.bit_length(), FILTER_BYTES // (n_shards * SLOTS * 2))


def build_filters(shared: DataFrame, n_shared: int, n_shards: int = N_SHARDS) -> tuple[DataFrame, int]:
    """(shard, data) for the keys of ``shared``, and the number of buckets of each.

    Keys are counted by shard first: those of a shard that can't hold them go nowhere.  So a task gets no more keys
    than a shard of the budget has slots, whatever their number.
    """
    n_buckets = buckets(n_shared, n_shards)
    rows = shared.select("key", _shard(n_shards).alias("shard"))
    full = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > n_buckets * SLOTS * LOAD).select("shard")  # n_shards rows at most
    built = rows.join(F.broadcast(full), "shard", "left_anti").groupBy("shard").applyInArrow(_build(n_buckets), "shard int, data binary")
    return built.unionByName(full.select("shard", F.lit(b"").alias("data"))), n_buckets


def _revise(n_buckets: int):
    def run(key: tuple, old: pa.Table, changes: pa.Table) -> pa.Table:
        again = changes.filter(changes["again"])["key"].to_pylist()
        if again:
            return _row(key, _filled(n_buckets, again))
        shard = Shard(n_buckets, old["data"][0].as_py() if old.num_rows else None)
        up = changes["up"].to_pylist()
        keys = changes["key"].to_pylist()
        shard.delete(b"".join(k for k, u in zip(keys, up, strict=True) if not u))
        shard.insert(b"".join(k for k, u in zip(keys, up, strict=True) if u))
        return _row(key, shard)

    return run


def revise_filters(
    filters: DataFrame, n_buckets: int, before: DataFrame, after: DataFrame, min_docs: int = MIN_DOCS, n_shards: int = N_SHARDS,
) -> DataFrame:
    """The filters after a change of counts: keys that cross ``min_docs`` are inserted or deleted.

    A saturated shard whose keys fit again is built from all of them (``again``); one
    whose keys don't fit stays saturated.
    """
    was = before.select("key", (F.col("n_docs") >= min_docs).alias("was"))
    now = after.select("key", (F.col("n_docs") >= min_docs).alias("up"))
    both = was.join(now, "key", "full").select("key", F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("up", F.lit(False)).alias("up"))
    both = both.withColumn("shard", _shard(n_shards))
    full = filters.where(F.length("data") == 0).select("shard")
    sizes = both.groupBy("shard").agg(F.count_if("up").alias("n")).where(F.col("n") <= n_buckets * SLOTS * LOAD)
    fits = full.join(sizes, "shard").select("shard", (F.col("n") > 0).alias("again"))  # a row a shard at most
    # an empty shard needs no row
    filters = filters.join(F.broadcast(fits.where("not again")), "shard", "left_anti")
    crossed = both.join(F.broadcast(fits), "shard", "left").withColumn("again", F.coalesce(F.col("again") & F.col("up"), F.lit(False)))
    still_full = full.join(fits, "shard", "left_anti")  # its keys aren't needed
    crossed = crossed.where("was != up or again").join(F.broadcast(still_full), "shard", "left_anti").select("key", "up", "again", "shard")
    return filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInArrow(_revise(n_buckets), "shard int, data binary")


def build_index(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> Index:
    """The index of documents (id, text), as work tables."""
    return revise_index(None, docs, None, min_chars, min_docs)


def revise_index(
    index: Index | None, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> Index:
    """``index`` after inserting and deleting documents (id, text), as work tables.

    Filters that the keys outgrow are built again, with more buckets, while the budget allows it.
    """
    state = C.stored(update(index.state if index else None, inserted, deleted, min_chars))
    shared = C.stored(counts(state).where(F.col("n_docs") >= min_docs))
    n_shared = shared.count()
    if index and buckets(n_shared) <= index.n_buckets:
        filters = revise_filters(index.filters, index.n_buckets, counts(index.state), counts(state), min_docs)
        return Index(state, C.stored(filters), index.n_buckets)
    filters, n_buckets = build_filters(shared, n_shared)
    return Index(state, C.stored(filters), n_buckets)


def load_filters(filters: DataFrame, n_buckets: int, n_shards: int = N_SHARDS) -> Filters:
    """On the driver: at most FILTER_BYTES."""
    return Filters(n_shards, n_buckets, {r["shard"]: bytes(r["data"]) for r in filters.collect()})


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for t, gone in zip(b["text"].to_pylist(), b["gone"].to_pylist(), strict=True):
                lines = (t or "").encode().split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if line_key(x, min_chars) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            yield pa.record_batch(
                [b["id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())],
                names=["id", "n_lines", "n_dropped", "kept_text"])

    return run


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    index: Index | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, n_dropped, kept_text (binary, UTF-8).

    With ``index``, made with the same ``min_chars`` and ``min_docs``, lines are counted
    over the documents it holds, which should include ``docs``; without, over ``docs``.

    Null and empty texts are one empty line.  Rows that share an id count as one
    document, and each loses its lines.  Rows with a null id aren't counted and keep
    all their lines.  Other columns are ignored, whatever their names; texts are split
    whole, whatever their length; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if index is None:
        shared = C.stored(counts(update(None, rows, min_chars=min_chars)).where(F.col("n_docs") >= min_docs))
        filters, n_buckets = build_filters(shared, shared.count())
    else:
        shared = counts(index.state).where(F.col("n_docs") >= min_docs)
        filters, n_buckets = index.filters, index.n_buckets
    probe = spark.sparkContext.broadcast(load_filters(filters, n_buckets))
    maybe = rows.where("id is not null").mapInArrow(_keys(min_chars, probe), "id long, key binary")
    gone = (
        maybe.join(shared, "key").where("id < last").groupBy("id").agg(F.collect_set("key").alias("gone"))
    )
    return (
        rows.join(gone, "id", "left").select("id", "text", "gone")
        .mapInArrow(_drop(min_chars), "id long, n_lines long, n_dropped long, kept_text binary")
        .withColumnRenamed("id", id_col)
    )
