"""Workflow files: JSON objects of nodes, bare or below "nodes" or "prompt"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NODES = "map<string,struct<class_type:string,inputs:map<string,string>,_meta:struct<title:string>>>"
#: Names below which a workflow may lie, in order.
WRAPPERS = ("nodes", "prompt")


def parsed(texts: DataFrame) -> DataFrame:
    """(workflow, nodes, error) of (workflow, json): a map of nodes, or why there is none.

    A text is a workflow if it, or what it holds as an object below a wrapper's name, is an object of
    objects, one of them with a class.
    """
    as_object = lambda c: F.when(F.ltrim(c).startswith("{"), c)
    wrapped = [as_object(F.get_json_object("json", f"$.{name}")) for name in WRAPPERS]
    inner = F.coalesce(*wrapped, F.col("json"))
    nodes = F.map_filter(F.from_json(as_object(inner), _NODES), lambda _, n: n["class_type"].isNotNull())
    found = texts.withColumn("nodes", nodes)
    error = F.when(F.col("json").isNull(), "no text").when(F.try_parse_json("json").isNull(), "not JSON").when(
        F.coalesce(F.size("nodes"), F.lit(0)) < 1, "no nodes: neither an object of nodes nor one below " + " or ".join(WRAPPERS))
    return found.select("workflow", F.when(error.isNull(), F.col("nodes")).alias("nodes"), error.alias("error"))


def nodes(texts: DataFrame, on_error: str = "error") -> DataFrame:
    """(workflow, node_id, class_type, title, inputs) of (workflow, json); inputs map names to JSON texts.

    A text that isn't a workflow fails the job, or with ``on_error`` = skip gives no rows (``parsed`` names them).
    """
    found = parsed(texts)
    if on_error == "error":
        message = F.concat(F.lit("workflow "), F.coalesce("workflow", F.lit("?")), F.lit(": "), "error")
        found = found.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return found.select("workflow", F.explode("nodes").alias("node_id", "n")).select(
        "workflow", "node_id", "n.class_type", F.col("n._meta.title").alias("title"), "n.inputs")


def read(spark: SparkSession, path: str, on_error: str = "error") -> DataFrame:
    """The nodes of the workflow files at ``path``; a file's name is its workflow."""
    name = F.regexp_extract("_metadata.file_path", r"([^/]*?)(?:\.json)?$", 1)
    return nodes(spark.read.text(path, wholetext=True).select(name.alias("workflow"), F.col("value").alias("json")), on_error)
