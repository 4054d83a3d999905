"""Connected components of a table of links, by labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable over ``links`` (a, b), for every id in them.

    Each round takes the least label of the neighbours (partial minima before the
    shuffle) and then the label of that label; rounds end when nothing changes.
    """
    edges = C.stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = C.stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id"))
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy("a").agg(F.min("label").alias("near"))
        )
        moved = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("next"))
        target = labels.select(F.col("id").alias("next"), F.col("label").alias("jump"))
        jumped = C.stored(
            moved.join(target, "next", "left").select("id", F.col("label").alias("old"), F.least("next", "jump").alias("label"))
        )
        changed = not jumped.where("old != label").isEmpty()
        labels = jumped.select("id", "label")
        if not changed:
            return labels


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` after adding ``links`` (a, b) to the graph: only the components that they join are labelled anew."""
    if labels is None:
        return components(links)
    a = labels.select(F.col("id").alias("a"), F.col("label").alias("_a"))
    b = labels.select(F.col("id").alias("b"), F.col("label").alias("_b"))
    roots = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    moved = components(roots.where("a != b").distinct()).select(F.col("id").alias("_root"), F.col("label").alias("_to"))
    old = labels.join(moved, labels["label"] == moved["_root"], "left").select("id", F.coalesce("_to", "label").alias("label"))
    new = moved.join(labels, moved["_root"] == labels["id"], "left_anti").select(F.col("_root").alias("id"), F.col("_to").alias("label"))
    return C.stored(old.unionByName(new))
