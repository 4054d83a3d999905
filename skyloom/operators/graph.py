"""Workflow graphs: nodes (node_id, class_type, inputs) and edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.work import cut


def edges_of(nodes: DataFrame) -> DataFrame:
    """(src, src_slot, dst, input) of nodes whose inputs map names to JSON texts: ["id", slot] is a link."""
    rows = nodes.select(F.col("node_id").alias("dst"), F.explode("inputs").alias("input", "raw"))
    pattern = r'^\["([^"]+)", ?([0-9]+)\]$'
    return rows.where(F.col("raw").rlike(pattern)).select(
        F.regexp_extract("raw", pattern, 1).alias("src"), F.regexp_extract("raw", pattern, 2).cast("int").alias("src_slot"), "dst", "input")


def live(edges: DataFrame, sinks: DataFrame) -> DataFrame:
    """Nodes from which a sink (node) can be reached; cycles are allowed."""
    seen = cut(sinks.select("node").distinct())
    front = seen
    while not front.isEmpty():
        front = cut(
            edges.join(front, edges["dst"] == front["node"]).select(F.col("src").alias("node")).distinct()
            .join(seen, "node", "left_anti"))
        seen = cut(seen.unionByName(front))
    return seen


def depths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, depth): the longest path from a source, by rounds over an acyclic graph; a cycle is an error."""
    depth = cut(nodes.select("node", F.lit(0).alias("depth")))
    for _ in range(nodes.count()):
        step = edges.join(depth.withColumnRenamed("node", "src"), "src").groupBy("dst").agg((F.max("depth") + 1).alias("next"))
        moved = cut(depth.join(step, depth["node"] == step["dst"], "left").select(
            "node", "depth", F.greatest("depth", F.coalesce("next", F.lit(0))).alias("next")))
        depth = moved.select("node", F.col("next").alias("depth"))
        if moved.where("next > depth").isEmpty():
            return depth
    raise ValueError("the graph has a cycle")


def bound(nodes: DataFrame, overrides: DataFrame) -> DataFrame:
    """``nodes`` with inputs replaced by ``overrides`` (node_id, inputs); others stay."""
    o = overrides.select("node_id", F.col("inputs").alias("_new"))
    merged = F.map_concat(
        F.map_filter("inputs", lambda k, _: ~F.map_contains_key("_new", k)), "_new")
    return nodes.join(o, "node_id", "left").withColumn("inputs", F.when(F.col("_new").isNull(), F.col("inputs")).otherwise(merged)).drop("_new")
