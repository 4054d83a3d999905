"""Asset sets: scans, resume plans, pairing and mask resolution, sharding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..sources.work import cut


def scan(files: DataFrame, path: str = "rel_path", bmp: bool = False, recursive: bool = True, pattern: str | None = None) -> DataFrame:
    """Image files of an inventory; ``pattern`` is a case-sensitive SQL LIKE, extensions are not."""
    out = files.where(P.is_image(F.col(path), bmp))
    if not recursive:
        out = out.where(~F.col(path).contains("/"))
    return out.where(F.col(path).like(pattern)) if pattern else out


def pending(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Inputs whose output doesn't exist yet: a left anti join."""
    return inputs.join(outputs.select(key), key, "left_anti")


def pending_all(expected: DataFrame, outputs: DataFrame, item: str, key: str) -> DataFrame:
    """Items of which at least one expected output is missing."""
    have = outputs.select(key).distinct().withColumn("_have", F.lit(True))
    return (
        expected.join(have, key, "left").groupBy(item)
        .agg(F.bool_and(F.coalesce("_have", F.lit(False))).alias("_all")).where(~F.col("_all")).select(item)
    )


def siblings(images: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each image (parent, stem, suffix) the best candidate of the same parent and stem.

    The image's own suffix comes first, then the fixed order of extensions.
    """
    order = F.array_position(F.array(*[F.lit(e) for e in P.SIBLING_EXTS]), F.col("c.suffix"))
    rank = F.when(F.col("c.suffix") == F.col("i.suffix"), 0).when(order > 0, order)
    best = Window.partitionBy("i.rel_path").orderBy("_rank")
    return (
        images.alias("i").join(candidates.alias("c"), (F.col("i.parent") == F.col("c.parent")) & (F.col("i.stem") == F.col("c.stem")))
        .withColumn("_rank", rank).where("_rank is not null")
        .withColumn("_n", F.row_number().over(best)).where("_n = 1")
        .select(F.col("i.rel_path").alias("rel_path"), F.col("c.rel_path").alias("sibling"))
    )


def resolve_masks(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Each image's mask: in its own folder, else at the root, else by a stem that is unique."""
    own = masks.select(F.col("rel_path").alias("own")).distinct()
    root = own.where(P.parent(F.col("own")) == "").select(F.col("own").alias("root"))
    by_stem = masks.groupBy(P.stem(F.col("rel_path")).alias("_stem")).agg(
        F.when(F.count("*") == 1, F.min("rel_path")).alias("unique"))
    at_root = F.concat("stem", F.lit(".png"))
    in_folder = F.when(F.col("parent") == "", at_root).otherwise(F.concat_ws("/", "parent", at_root))
    return (
        images.join(own, in_folder == F.col("own"), "left").join(root, at_root == F.col("root"), "left")
        .join(by_stem, F.col("stem") == F.col("_stem"), "left")
        .select("rel_path", F.coalesce("own", "root", "unique").alias("mask"))
    )


def ranked(files: DataFrame, key: Column) -> DataFrame:
    """``files`` with _rank, the place in the whole list by ``key`` (from 0), and _total, its length.

    The list is range-partitioned by sampled splitters and sorted in its partitions;
    only a count per partition meets in one place, and is broadcast.
    """
    at = F.monotonically_increasing_id()
    local = cut(
        files.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key").drop("_key")
        .withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))).withColumn("_part", F.shiftright(at, 33)))
    up = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = local.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(up), F.lit(0)))
    starts = starts.withColumn("_total", F.sum("_n").over(Window.partitionBy(F.lit(0)))).drop("_n")
    return local.join(F.broadcast(starts), "_part").withColumn("_rank", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def contiguous(n: int) -> Column:
    """Shard of a balanced contiguous split of a ranked list: the first ``total % n`` shards get one more."""
    rank, size, more = F.col("_rank"), F.floor(F.col("_total") / n), F.col("_total") % n
    long = more * (size + 1)
    return F.when(rank < long, F.floor(rank / (size + 1))).otherwise(more + F.floor((rank - long) / F.greatest(size, F.lit(1))))


def round_robin(n: int) -> Column:
    return F.col("_rank") % n


def renamed(files: DataFrame, shard: str = "shard") -> DataFrame:
    """``files`` with dst_name: in path order each takes the first free name of stem, stem__dup001, stem__dup002 and so on.

    Suffixes become lower case.  The files of a stem take rising numbers, so each starts at its rank.
    Only where a file's own stem ends with such a number can names collide: there the earliest path keeps
    the name, the others go on to the next number, and rounds end when no name repeats.
    """
    low, path = F.lower("suffix"), P.sort_key(F.col("rel_path"))
    same = Window.partitionBy(shard, "stem", low).orderBy(path, "rel_path")
    number = F.when(F.col("_n") > 0, F.concat(F.lit("__dup"), F.lpad(F.col("_n").cast("string"), F.greatest(F.lit(3), F.length(F.col("_n").cast("string"))), "0"))).otherwise("")
    named = lambda df: df.withColumn("dst_name", F.concat("stem", number, low))
    root = [shard, "_root", "_low"]
    out = files.withColumn("_n", F.row_number().over(same) - 1).withColumn("_root", F.regexp_replace("stem", "(?:__dup[0-9]{3,})+$", "")).withColumn("_low", low)
    numbered = out.where(F.col("stem") != F.col("_root")).select(*root).distinct()
    plain, open_ = out.join(numbered, root, "left_anti"), cut(named(out.join(numbered, root, "left_semi")))
    taken = Window.partitionBy(shard, "dst_name").orderBy(path, "rel_path")
    while not open_.groupBy(shard, "dst_name").count().where("count > 1").isEmpty():
        moved = open_.withColumn("_n", F.col("_n") + F.when(F.row_number().over(taken) > 1, 1).otherwise(0))
        rank = F.row_number().over(same)
        rising = rank + F.max(F.col("_n") - F.col("_rank")).over(same)
        open_ = cut(named(moved.withColumn("_rank", rank).withColumn("_n", rising).drop("_rank")))
    return named(plain).unionByName(open_.select(*named(plain).columns)).drop("_n", "_root", "_low")
