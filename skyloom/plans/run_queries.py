"""Queries on runs: events are run events, conversations ordered stages, orders shards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import boxes as B  # noqa: F401
from ..operators import runs as R
from ..sources import images as I
from ..sources import records as J
from .base import query, table

STAGES = ("click", "view", "purchase", "signup", "error")


def events(spark, sf):
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    return e.select(
        "event_id", "ts", F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), status.alias("status"),
        F.col("value").alias("elapsed_sec"), "props")


_EV = """e AS (SELECT event_id, ts, user_id AS run_id, event_type AS stage, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
    value AS elapsed_sec, props FROM events)"""


@query("events_failures", f"WITH {_EV} SELECT event_id, run_id, stage, elapsed_sec FROM e WHERE status = 'failure'")
def events_failures(spark, sf):
    return R.failures(events(spark, sf), "event_id", "run_id", "stage", "elapsed_sec")


@query("run_totals", f"""WITH {_EV} SELECT run_id, count(*) AS n_events, count(*) FILTER (status = 'failure') AS n_failures,
    round(sum(elapsed_sec), 4) AS elapsed_sec, min(ts) AS first_ts, max(ts) AS last_ts FROM e GROUP BY run_id""")
def run_totals(spark, sf):
    return R.totals(events(spark, sf))


@query("stage_funnel", "SELECT " + ", ".join(f"count(*) FILTER (event_type = '{s}') AS count_{s}" for s in STAGES) + " FROM events")
def stage_funnel(spark, sf):
    return R.funnel(events(spark, sf), list(STAGES))


@query("stage_durations", f"WITH {_EV} SELECT run_id, stage, epoch_us(max(ts) - min(ts)) // 1000000 AS elapsed, count(*) AS n FROM e GROUP BY 1, 2")
def stage_durations(spark, sf):
    return R.durations(events(spark, sf))


@query("first_failure", f"""WITH {_EV}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS n FROM e WHERE status = 'failure')
    SELECT run_id, event_id, stage, elapsed_sec FROM r WHERE n = 1""")
def first_failure(spark, sf):
    return R.first_failure(events(spark, sf))


@query("event_record", """SELECT event_id, '{"event":"' || event_type || '","run_id":' || user_id || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"reason":"r' || event_id % 3 || '"' END
    || ',"exit_code":' || event_id % 2 || '}' AS record FROM events""")
def event_record(spark, sf):
    i = F.col("event_id")
    reason = F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("r"), i % 3))
    cols = {"event": F.col("event_type"), "run_id": F.col("user_id"), "reason": reason, "stage": F.lit(None).cast("string"), "exit_code": i % 2}
    return table(spark, sf, "events").select("event_id", J.event_json(cols).alias("record"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.none'), 'default') AS missing FROM events")
def json_extract(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.none"), F.lit("default")).alias("missing"))


@query("run_hierarchy", """SELECT r_name AS parent, n_name AS child, count(c_custkey) AS leaves FROM region JOIN nation ON n_regionkey = r_regionkey
    LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def run_hierarchy(spark, sf):
    leaves = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("leaves"))
    r, n = table(spark, sf, "region"), table(spark, sf, "nation")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(leaves, "n_nationkey", "left").select(
        F.col("r_name").alias("parent"), F.col("n_name").alias("child"), F.coalesce("leaves", F.lit(0)).alias("leaves"))


_RC = "CASE o_orderstatus WHEN 'F' THEN ' 0 ' WHEN 'O' THEN '3' END"


@query("shard_outcome", f"""WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
    o AS (SELECT o_orderkey AS shard, coalesce(trim({_RC}), 'missing') AS rc FROM orders)
    SELECT shard, rc, coalesce(n, 0) AS n_out, CASE WHEN rc = '0' THEN 'success' ELSE 'failure' END AS status, TRY_CAST(rc AS INT) AS exit_code FROM o LEFT JOIN l ON k = shard""")
def shard_outcome(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "shard")
    rc = F.when(F.col("o_orderstatus") == "F", " 0 ").when(F.col("o_orderstatus") == "O", "3")
    made = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").groupBy(F.col("l_orderkey").alias("shard")).agg(F.count("*").alias("n_out"))
    codes = o.select("shard", rc.alias("rc")).where("rc is not null")
    return R.outcomes(o.select("shard"), codes, made)


@query("launch_plan_scan", "SELECT CAST(s_suppkey % 8 AS VARCHAR) AS gpu_id, CAST(s_suppkey AS INT) AS idx, 'worker-g' || s_suppkey % 8 AS container_name, 's' || s_suppkey AS child_run_id FROM supplier")
def launch_plan_scan(spark, sf):
    """A plan in its tab-separated form, read back by its schema."""
    s = table(spark, sf, "supplier")
    gpu = (F.col("s_suppkey") % 8).cast("string")
    line = F.concat_ws("\t", gpu, F.col("s_suppkey").cast("string"), F.concat(F.lit("worker-g"), gpu), F.lit("b"), F.lit("/d"), F.lit("t"), F.lit("/rc"),
                       F.concat(F.lit("s"), F.col("s_suppkey")), F.lit("/log"), F.lit("/ev"))
    schema = ", ".join(f"{c} {'int' if c == 'idx' else 'string'}" for c in J.PLAN_COLUMNS)
    return s.select(F.from_csv(line, schema, {"sep": "\t"}).alias("p")).select("p.gpu_id", "p.idx", "p.container_name", "p.child_run_id")


@query("port_alloc", "SELECT s_nationkey AS host, s_suppkey AS worker, CAST(8188 + row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS INT) AS port FROM supplier")
def port_alloc(spark, sf):
    idx = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    return table(spark, sf, "supplier").select(F.col("s_nationkey").alias("host"), F.col("s_suppkey").alias("worker"), (8188 + idx).alias("port"))


@query("stage_gate", """WITH s AS (SELECT conv_id AS run, turn AS ord, 'stage' || turn AS stage FROM conversations), t AS (SELECT run, min(ord) AS stop FROM s WHERE stage = 'stage2' GROUP BY run)
    SELECT s.run, ord, stage, CASE WHEN stop IS NULL OR ord <= stop THEN 'run' ELSE 'skip' END AS action FROM s LEFT JOIN t ON t.run = s.run""")
def stage_gate(spark, sf):
    s = table(spark, sf, "conversations").select(F.col("conv_id").alias("run"), F.col("turn").alias("ord"), F.concat(F.lit("stage"), "turn").alias("stage"))
    return R.gated(s, "stage2")


def _bytes_total(spark, sf, read):
    """The rasters after the sink: their sizes and the sums of their bytes."""
    byte = lambda i: F.conv(F.hex(F.substring(F.col("data"), i, F.lit(1))), 16, 10).cast("bigint")
    total = F.aggregate(F.sequence(F.lit(1), F.length("data")), F.lit(0).cast("bigint"), lambda s, i: s + byte(i))
    return read.select("img", "h", "w", total.alias("total"))


_TOTAL = """SELECT vec_id AS img, 8 AS h, 8 AS w, CAST(sum(floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (embedding[i + 1]::DOUBLE + 1) / 2)) * 255)) AS BIGINT) AS total
    FROM embeddings, range(64) t(i) GROUP BY 1"""


@query("sink_raster_parquet", _TOTAL)
def sink_raster_parquet(spark, sf):
    """Rasters written as a table of bytes, and read from it."""
    from .raster_queries import N, pixels

    return _bytes_total(spark, sf, I.committed(I.packed(pixels(spark, sf), N, N)))


@query("sink_png", _TOTAL)
def sink_png(spark, sf):
    """Rasters written as a table of PNG files, and read from it."""
    from .raster_queries import N, pixels

    return _bytes_total(spark, sf, I.decoded(I.committed(I.as_png(I.packed(pixels(spark, sf), N, N)))))


@query("run_ids", "SELECT conv_id AS run, 'run_' || substr(md5(conv_id::VARCHAR), 1, 12) AS run_id, count(*) AS stages FROM conversations GROUP BY 1")
def run_ids(spark, sf):
    """A short id of each run, from its key, so reruns agree."""
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("run")).agg(F.count("*").alias("stages"))
    return c.select("run", R.run_id(F.col("run").cast("string")).alias("run_id"), "stages")
