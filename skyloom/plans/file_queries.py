"""Queries that write files and read them again: growing logs as a stream, staged files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import scalars as S
from ..operators import assets as A
from ..operators import frames as FR
from ..operators import jobs as J
from ..operators import models as M
from ..sources import copies, image_sink, work
from ..streaming import states, tail
from . import frame_queries as Q
from .base import query, table
from .frame_queries import _FR, frames

N_SHARDS = 3


def _append(lines, folder):
    """Appends lines (file, line) to the files of a folder; a file's lines are in one task."""
    def run(batches):
        fs, root = image_sink.located(folder)
        fs.create_dir(root)
        for b in batches:
            of = {}
            for name, line in zip(b["file"].to_pylist(), b["line"].to_pylist(), strict=True):
                of.setdefault(name, []).append(line)
            for name, some in of.items():
                with fs.open_append_stream(f"{root}/{name}") as out:
                    out.write(("\n".join(some) + "\n").encode())
            yield pa.record_batch([b["file"]], names=["file"])

    lines.repartition("file").mapInArrow(run, "file string").count()


@query("tail_windows", """SELECT time_bucket(INTERVAL 10 MINUTES, ts::TIMESTAMP) AS start, event_type AS stage, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_failures FROM events GROUP BY 1, 2""")
def tail_windows(spark, sf):
    """Events appended to the same seven files in two goes, followed by a stream that is stopped in between: every line once."""
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.to_json(F.struct(ts.alias("ts"), F.col("event_type").alias("stage"), status.alias("status"), F.col("event_id").cast("string").alias("reason")))
    lines = e.select("event_id", F.concat(F.lit("run_"), F.col("user_id") % 7, F.lit(".jsonl")).alias("file"), line.alias("line"))
    folder, out, checkpoint = (work.shared_path(spark) for _ in range(3))
    for half in (0, 1):
        _append(lines.where(F.col("event_id") % 2 == half), folder)
        stream = tail.growing_events(spark, folder).select("ts", "stage", "status")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("ts string, stage string, status string").parquet(out)
    at = F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return rows.groupBy(F.window(at, "10 minutes").alias("w"), "stage").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "failure").alias("n_failures")).select(F.col("w.start").alias("start"), "stage", "n", "n_failures")


@query("stream_run_states", """WITH r AS (SELECT user_id AS run_id, count(*) AS n_events, count(*) FILTER (event_type = 'error') AS n_failures, bool_or(event_type = 'purchase' AND event_id % 50 = 7) AS ended, max(ts) AS last FROM events GROUP BY 1)
    SELECT run_id::VARCHAR AS run_id, CASE WHEN ended THEN 'success' WHEN epoch_ms(last) + 1800000 < (SELECT max(epoch_ms(ts)) FROM events) - 600000 THEN 'lost' ELSE 'open' END AS status, n_events, n_failures FROM r""")
def stream_run_states(spark, sf):
    """The last state of each run, followed as a stream with timeouts: some purchases end a run, half an hour of silence loses it."""
    kind = F.col("event_type")
    rows = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.when((kind == "purchase") & (F.col("event_id") % 50 == 7), states.END).otherwise(kind).alias("event"),
        F.when(kind == "error", "failure").otherwise("success").alias("status"), F.col("ts").cast("timestamp").alias("at"))
    folder, out, checkpoint = (work.shared_path(spark) for _ in range(3))
    rows.write.parquet(folder)

    def put(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    stream = states.run_states(spark.readStream.schema(rows.schema).parquet(folder))
    stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.schema(f"{states.OUT}, batch long").parquet(out)
    last = seen.groupBy("run_id").agg(F.max_by(F.struct("status", "n_events", "n_failures"), "batch").alias("s"))
    return last.select("run_id", "s.status", "s.n_events", "s.n_failures")


@query("stage_files", f"""WITH {_FR}, f AS (SELECT DISTINCT img FROM px), r AS (SELECT img, row_number() OVER (ORDER BY 'in' || img % 4, img) - 1 AS k, count(*) OVER () AS total FROM f),
    s AS (SELECT img, CAST(CASE WHEN k < total % {N_SHARDS} * (total // {N_SHARDS} + 1) THEN k // (total // {N_SHARDS} + 1)
      ELSE total % {N_SHARDS} + (k - total % {N_SHARDS} * (total // {N_SHARDS} + 1)) // (total // {N_SHARDS}) END AS INT) AS shard FROM r)
    SELECT 'in' || img % 4 || '/f' || lpad(img::VARCHAR, 6, '0') || '.PNG' AS src, 'gpu' || shard || '/f' || lpad(img::VARCHAR, 6, '0') || '.png' AS dst, true AS same, false AS kept_before, true AS kept_after FROM s""")
def stage_files(spark, sf):
    """Frames as files, linked or copied into balanced shards under their staging names, and once more: then all are kept. same: as long as the source."""
    name = F.concat(F.lit("in"), F.col("img") % 4, F.lit("/f"), F.lpad(F.col("img").cast("string"), 6, "0"), F.lit(".PNG"))
    source, target = work.shared_path(spark), work.shared_path(spark)
    images = FR.as_bytes(frames(spark, sf), name)
    image_sink.write_images(images, source)
    files = images.select(F.col("path").alias("rel_path"), P.stem(F.col("path")).alias("stem"), P.suffix(F.col("path")).alias("suffix"))
    plan = A.renamed(A.ranked(files, P.sort_key(F.col("rel_path"))).withColumn("shard", A.contiguous(N_SHARDS).cast("int")))
    plan = work.cut(plan.select(F.col("rel_path").alias("src"), F.concat(F.lit("gpu"), "shard", F.lit("/"), "dst_name").alias("dst")))
    first, again = (work.cut(copies.carried_out(plan, source, target)) for _ in range(2))
    listed = lambda folder, column: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
        F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias(column), F.col("length").alias(f"n_{column}"))
    return (
        first.join(again.select("dst", F.col("how").alias("again")), "dst").join(listed(source, "src"), "src").join(listed(target, "dst"), "dst")
        .select("src", "dst", (F.col("n_src") == F.col("n_dst")).alias("same"), (F.col("how") == "kept").alias("kept_before"), (F.col("again") == "kept").alias("kept_after")))


#: Frames as they are read from files: their values are bytes.
_FRQ = f"{_FR.replace('px AS', 'pz AS', 1)}, px AS MATERIALIZED (SELECT * REPLACE (floor(v * 255 + 1e-9) / 255.0::DOUBLE AS v) FROM pz)"


@query("blur_folder", f"""WITH {_FRQ}, {Q._CUBE}, {Q._boxes_sql("bx")}, n AS (SELECT img, count(*) FILTER (typ = 'F') AS f, count(*) FILTER (typ = 'LP') AS p FROM bx GROUP BY img),
    i AS (SELECT DISTINCT img, 'in' || img % 4 || '/f' || lpad(img::VARCHAR, 6, '0') AS name FROM px)
    SELECT name || '.png' AS image, coalesce(f, 0) AS face_boxes, coalesce(p, 0) AS lp_boxes, coalesce(f, 0) + coalesce(p, 0) AS total_boxes, name || '_blur.jpg' AS blur_output, name || '_annot.jpg' AS annot_output,
      NULL::VARCHAR AS error, 2::BIGINT AS n_files, 0::BIGINT AS again FROM i LEFT JOIN n USING (img)""")
def blur_folder(spark, sf):
    """A folder of images blurred and annotated into another one, and once more: then nothing is left to do."""
    source, target = work.shared_path(spark), work.shared_path(spark)
    image_sink.write_images(FR.as_bytes(frames(spark, sf), F.concat(F.lit("in"), F.col("img") % 4, F.lit("/f"), F.lpad(F.col("img").cast("string"), 6, "0"), F.lit(".png"))), source)
    slots = {"F": M.Slot("bright", M.box_finder, Q.FIND_F), "LP": M.Slot("dark", M.box_finder, Q.FIND_LP)}
    run = lambda: J.blur_folder(spark, source, target, slots, Q.FACE, Q.LEAST_CONF, Q.BLUR)
    rows = run()
    again = run().count()
    made = J.listed(spark, target).groupBy(F.regexp_replace("rel_path", "_[a-z]+\\.jpg$", ".png").alias("image")).agg(F.count("*").alias("n_files"))
    return rows.join(made, "image").withColumn("again", F.lit(again).cast("long"))


@query("shell_words", r"""SELECT doc_id, CASE WHEN text = '' THEN '''''' WHEN regexp_matches(text, '[\x01-\x1f]') THEN
      '$''' || replace(replace(replace(regexp_replace(text, '([\\''])', '\\\1', 'g'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r') || ''''
    ELSE regexp_replace(text, '([^A-Za-z0-9_@%+=:,./\x{80}-\x{10FFFF}-])', '\\\1', 'g') END AS word FROM documents""")
def shell_words(spark, sf):
    """Each whole text as one word of a command."""
    return table(spark, sf, "documents").select("doc_id", S.shell_word(F.col("text")).alias("word"))
