"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1], linear here:
w(t) = 1 + slope * (2t - 1), times the source's target.  Its integral is the
source's cumulative demand, target * (t + slope * (t*t - t)).  A source's documents
lie one after the other, in seeded order, on its token stream, which may be read up
to ``max_repeats`` times; a copy is taken if its middle lies before the target, and
its training position is the time at which cumulative demand reaches its start.
The mix is range-sorted by position.  Every row has a key of its own, so positions meet
their texts by one even join, whatever ids repeat or lack.

A source may hold any share of all rows: its stream is cut into buckets of seeded
hashes, of about ``BUCKET_ROWS`` rows; sums are taken by bucket before the running
sum over a source's buckets, and rows are summed within buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Fixed weights of sources by rank, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2
BUCKET_ROWS = 4096
#: Slopes of the schedules by rank, repeating: early, even and late sources.
SLOPES = (-0.6, 0.0, 0.6)


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """(source, n_rows, source_size, target, slope): one row per source.

    ``share`` times all words are shared by weight; a target stops at
    ``max_repeats`` times its source, and the excess is shared again by weight until
    none is above.  That is a water level: targets are min(cap, level * weight),
    found in one pass over the sources ordered by cap / weight.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    # Sources are a catalogue: one row each, whatever the rows of documents.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(i, F.lit(len(values))) + 1).cast("int"))
    per = per.withColumn("i", F.row_number().over(by_name) - 1)
    per = per.withColumn("w", pick(weights, F.col("i"))).withColumn("slope", pick(SLOPES, F.col("i")))
    per = per.withColumn("cap", F.col("source_size") * float(max_repeats)).withColumn("ratio", F.col("cap") / F.col("w"))
    everyone = Window.partitionBy(F.lit(0))
    up = everyone.orderBy("ratio", "i").rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everyone) * float(share))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(up), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(up), F.lit(0.0)))
        .withColumn("capped", F.col("left") >= F.col("ratio") * F.col("w_left"))
    )
    # the level is set by the first source that its cap doesn't stop
    level = F.min(F.when(~F.col("capped"), F.struct("ratio", "i", (F.col("left") / F.col("w_left")).alias("level")))).over(everyone)
    return per.withColumn("level", level["level"]).select(
        "source", "n_rows", "source_size", "slope",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w"))).alias("target"),
    )


def _position(start: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``start`` words."""
    u, k = start / F.col("target"), F.col("slope")
    # k*t*t + (1 - k)*t = u
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - k) * (1 - k) + 4 * k * u))
    return F.when(F.col("target") <= 0, F.lit(None)).when(k == 0, u).otherwise((root - (1 - k)) / (2 * k)) + 0.0


def _assigned(
    docs: DataFrame, id_col: str, text_col: str, source_col: str,
    weights: tuple[float, ...], share: float, max_repeats: int, seed: int, row_col: str | None = None,
) -> DataFrame:
    """The result of ``assign`` with _row, a key of each row (``row_col``, or a new one), and _h, its seeded hash."""
    rest = [c for c in docs.columns if c not in _OUT and c not in (text_col, "_row", "_h")]
    text = C.text_or_empty(f"`{text_col}`")
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(
        *[F.col(f"`{c}`") for c in rest], row.alias("_row"), F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source_col}`").alias("_source"), C.word_count(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text).alias("_h"),
    )
    rows = C.stored(rows)  # sizes are needed three times
    targets = source_targets(rows.select(F.col("_source").alias("source"), "size"), weights, share, max_repeats)
    targets = C.stored(targets.withColumnRenamed("source", "_s"))
    spread = F.floor((F.col("_h") / 2.0**64 + 0.5) * F.ceil(F.col("n_rows") / BUCKET_ROWS)).cast("long")
    same = F.col("_source").eqNullSafe(F.col("_s"))
    rows = rows.join(targets, same).drop("_s").withColumn("_bucket", spread)
    sums = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_bucket")
    sums = sums.select(
        F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_h", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(sums, same & (F.col("_bucket") == F.col("_b")))
    rows = rows.withColumn("_start", F.col("_before") + F.sum("size").over(inside) - F.col("size"))
    starts = F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda e: F.col("_start") + e * F.col("source_size"))
    rows = rows.withColumn("_starts", F.filter(starts, lambda s: s + F.col("size") / 2 < F.col("target")))
    return rows.select(
        *[F.col(f"`{c}`") for c in rest], "_row", "_h", "size", "source_size", "target",
        F.size("_starts").alias("copies"), (F.size("_starts") * F.col("size")).cast("long").alias("taken"),
        F.transform("_starts", lambda s: _position(s)).alias("positions"),
    )


_OUT = {"size", "source_size", "target", "copies", "taken", "positions", "places"}


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS, seed: int = 17,
) -> DataFrame:
    """``docs`` without the text, and size, source_size, target, copies, taken, positions.

    ``positions`` has a training time in [0, 1) for each copy that is taken.  Null
    texts have no words: they are taken with the words around them, at size 0.
    Null sources are a source of their own, ranked last.  Rows are ordered by a seeded
    hash of id and text: rows that repeat both are taken one by one and are
    interchangeable.  Columns of ``docs`` that have the names of result columns are
    replaced; an empty table gives an empty result; a text is never held but by its row.
    """
    return _assigned(docs, id_col, text_col, source_col, weights, share, max_repeats, seed).drop("_row", "_h")


def placed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS, seed: int = 17,
) -> DataFrame:
    """The result of ``assign`` with ``places``: where the row's copies lie in the range-sorted mix, from 0."""
    plan = C.stored(_assigned(docs, id_col, text_col, source_col, weights, share, max_repeats, seed))
    copies = plan.select("_row", "_h", F.explode("positions").alias("position"))
    back = C.ranked(copies, "position", "_h", name="place").groupBy("_row").agg(F.sort_array(F.collect_list("place")).alias("places"))
    out = plan.drop("_h").join(back, "_row", "left").drop("_row")
    return out.withColumn("places", F.coalesce("places", F.array().cast("array<bigint>")))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS, seed: int = 17,
) -> DataFrame:
    """The mix itself: the rows of ``docs`` once for each copy, range-sorted by ``position``.

    Two exchanges carry the texts: the join with their positions, and the sort.  Nulls,
    repeats and empty tables are as for ``assign``; a column named position is replaced.
    """
    given = [c for c in docs.columns if c != "position"]
    inner = {c: f"_c{i}" for i, c in enumerate(given)}
    rows = C.stored(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], F.monotonically_increasing_id().alias("_row")))
    i, t, s = inner[id_col], inner[text_col], inner[source_col]
    plan = _assigned(rows.select("_row", i, t, s), i, t, s, weights, share, max_repeats, seed, "_row")
    places = plan.where("copies > 0").select("_row", "_h", "positions")
    mixed = rows.join(places, "_row").select(*inner.values(), "_h", F.explode("positions").alias("position"))
    mixed = mixed.repartitionByRange(C.n_tasks(docs), "position", "_h").sortWithinPartitions("position", "_h")
    return mixed.select(*[F.col(n).alias(c) for c, n in inner.items()], "position")
