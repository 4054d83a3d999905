"""Queries on workflow graphs: each conversation stands for a workflow, each turn for a node, as JSON text.

A turn takes the image of the turn at half its number and the samples of the turn before.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph as G
from ..sources import workflows as W
from .base import query, table

#: Fixed suffixes of two save nodes; others are numbered.
SUFFIXES = {"2": "comfyui_carremoved", "5": "comfyui_newsky"}
#: What a workflow must hold: (node, class).
WANTED = (("0", "LoadImage"), ("2", "ImageSave"), ("77", "KSampler"))


def texts(spark, sf):
    """(workflow, json): a third of the workflows lies below "prompt", a third below "nodes"."""
    t = table(spark, sf, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    kind = F.expr("CASE WHEN turn % 3 = 2 THEN 'ImageSave' WHEN role = 'user' THEN 'LoadImage' ELSE 'KSampler' END")
    link = lambda name, to: F.when(F.col("turn") > 0, F.format_string(f'"{name}":["%d", 0],', to)).otherwise("")
    node = F.concat(
        F.format_string('"%d":{"inputs":{', "turn"), link("image", F.expr("turn div 2")), link("samples", F.col("turn") - 1),
        F.format_string('"seed":%d},"class_type":"%s","_meta":{"title":"turn"}}', F.col("turn") * 7, kind))
    bare = F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(node)), ","), F.lit("}"))
    below = lambda name: F.concat(F.lit(f'{{"client_id":"c","{name}":'), F.col("bare"), F.lit("}"))
    third = F.col("conv_id") % 3
    json = F.when(third == 0, F.col("bare")).when(third == 1, below("prompt")).otherwise(below("nodes"))
    return t.groupBy("conv_id").agg(bare.alias("bare")).select(F.col("conv_id").cast("string").alias("workflow"), json.alias("json"))


def nodes(spark, sf):
    """Nodes of all workflows, as one graph: ids are workflow:node."""
    n = W.nodes(texts(spark, sf))
    return n.withColumn("node_id", F.concat("workflow", F.lit(":"), "node_id"))


def edges(n):
    e = G.edges_of(n)
    return e.withColumn("src", F.concat(F.substring_index("dst", ":", 1), F.lit(":"), "src"))


_N = """t AS (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY 1, 2),
    n AS (SELECT conv_id || ':' || turn AS node_id, conv_id, turn, CASE WHEN turn % 3 = 2 THEN 'ImageSave' WHEN role = 'user' THEN 'LoadImage' ELSE 'KSampler' END AS class_type FROM t)"""
_E = """e AS (SELECT conv_id || ':' || turn // 2 AS src, node_id AS dst, 'image' AS input FROM n WHERE turn > 0
    UNION ALL SELECT conv_id || ':' || turn - 1, node_id, 'samples' FROM n WHERE turn > 0)"""


@query("workflow_nodes", f"WITH {_N} SELECT node_id, class_type, 'turn' AS title, CASE WHEN turn > 0 THEN 3 ELSE 1 END AS n_inputs FROM n")
def workflow_nodes(spark, sf):
    return nodes(spark, sf).select("node_id", "class_type", "title", F.size("inputs").alias("n_inputs"))


@query("workflow_edges", f"WITH {_N}, {_E} SELECT src, 0 AS src_slot, dst, input FROM e")
def workflow_edges(spark, sf):
    return edges(nodes(spark, sf))


@query("workflow_validate", f"""WITH {_N}, w(node, want) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in WANTED)}),
    k AS (SELECT DISTINCT conv_id || ':' || node AS node_id, want FROM n, w)
    SELECT k.node_id, coalesce(n.class_type = want, false) AS ok FROM k LEFT JOIN n USING (node_id)""")
def workflow_validate(spark, sf):
    n = nodes(spark, sf)
    want = F.explode(F.create_map(*[F.lit(x) for pair in WANTED for x in pair]))
    keys = n.select("workflow").distinct().select("workflow", want.alias("node", "want"))
    keys = keys.select(F.concat("workflow", F.lit(":"), "node").alias("node_id"), "want")
    return keys.join(n, "node_id", "left").select("node_id", F.coalesce(F.col("class_type") == F.col("want"), F.lit(False)).alias("ok"))


@query("workflow_live", f"""WITH RECURSIVE {_N}, {_E}, r(node) AS (SELECT node_id FROM n WHERE class_type = 'ImageSave' UNION SELECT e.src FROM r JOIN e ON e.dst = r.node)
    SELECT n.node_id AS node, r.node IS NOT NULL AS live FROM n LEFT JOIN r ON r.node = n.node_id""")
def workflow_live(spark, sf):
    n = nodes(spark, sf)
    sinks = n.where("class_type = 'ImageSave'").select(F.col("node_id").alias("node"))
    alive = G.live(edges(n), sinks).withColumn("live", F.lit(True))
    return n.select(F.col("node_id").alias("node")).join(alive, "node", "left").select("node", F.coalesce("live", F.lit(False)).alias("live"))


@query("workflow_depth", f"WITH {_N} SELECT node_id AS node, CAST(turn AS INT) AS depth FROM n")
def workflow_depth(spark, sf):
    """The samples of the turn before make each workflow a chain, so the longest path ends at the turn's number."""
    n = nodes(spark, sf)
    return G.depths(edges(n), n.select(F.col("node_id").alias("node")))


@query("workflow_bind", f"""WITH {_N}, i AS (SELECT node_id, 'image' AS k, '["' || turn // 2 || '",0]' AS v FROM n WHERE turn > 0
    UNION ALL SELECT node_id, 'samples', '["' || turn - 1 || '",0]' FROM n WHERE turn > 0 UNION ALL SELECT node_id, 'seed', (turn * 7)::VARCHAR FROM n),
    o AS (SELECT conv_id || ':0' AS node_id, 'image' AS k, '"in/' || conv_id || '.jpg"' AS v FROM (SELECT DISTINCT conv_id FROM n)
    UNION ALL SELECT conv_id || ':2', 'image', '"out"' FROM (SELECT DISTINCT conv_id FROM n WHERE turn = 2))
    SELECT coalesce(o.node_id, i.node_id) AS node_id, coalesce(o.k, i.k) AS k, coalesce(o.v, i.v) AS v FROM i FULL JOIN o ON o.node_id = i.node_id AND o.k = i.k""")
def workflow_bind(spark, sf):
    n = nodes(spark, sf)
    w = n.select("workflow").distinct()
    new = lambda node, v: w.select(F.concat("workflow", F.lit(f":{node}")).alias("node_id"), F.create_map(F.lit("image"), v).alias("inputs"))
    o = new(0, F.format_string('"in/%s.jpg"', "workflow")).unionByName(new(2, F.lit('"out"')))
    return G.bound(n, o).select("node_id", F.explode("inputs").alias("k", "v"))


@query("save_suffix_map", f"""WITH {_N}, s AS (SELECT node_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx FROM n WHERE class_type IN ('ImageSave', 'ImageLoad'))
    SELECT node_id, CAST(idx AS INT) AS idx, CASE turn WHEN 2 THEN 'comfyui_carremoved' WHEN 5 THEN 'comfyui_newsky' ELSE CASE WHEN idx = 0 THEN 'comfyui' ELSE 'comfyui_' || turn END END AS suffix FROM s""")
def save_suffix_map(spark, sf):
    known = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])
    node = F.substring_index("node_id", ":", -1)
    s = nodes(spark, sf).where(F.col("class_type").isin("ImageSave", "ImageLoad"))
    s = s.withColumn("idx", F.row_number().over(Window.partitionBy("workflow").orderBy(node.cast("int"))) - 1)
    other = F.when(F.col("idx") == 0, "comfyui").otherwise(F.concat(F.lit("comfyui_"), node))
    return s.select("node_id", "idx", F.coalesce(F.try_element_at(known, node), other).alias("suffix"))
