"""Queries on asset sets: documents stand for image files, labels for existing outputs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import scalars as S
from ..operators import assets as A
from .base import query, table

EXTS = (".jpg", ".JPG", ".jpeg", ".png", ".webp", ".tif", ".tiff", ".bmp", ".txt")
N_SHARDS = 7


def inventory(spark, sf):
    """doc_id, rel_path, parent, stem, suffix, length."""
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTS]), (F.col("doc_id") % 9 + 1).cast("int"))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.concat("source", F.lit("/doc_"), "doc_id", ext).alias("rel_path"), F.col("n_chars").alias("length"))
    p = F.col("rel_path")
    return rows.select("doc_id", "rel_path", P.parent(p).alias("parent"), P.stem(p).alias("stem"), P.suffix(p).alias("suffix"), "length")


def done(spark, sf, flag):
    return table(spark, sf, "labels").where(F.col(flag) == 1).select("doc_id")


_INV = f"""a AS (SELECT doc_id, source || '/doc_' || doc_id || ext AS rel_path, source AS parent, 'doc_' || doc_id AS stem,
    ext AS suffix, n_chars AS length FROM (SELECT *, list_extract({list(EXTS)}, CAST(doc_id % 9 AS INT) + 1) AS ext FROM documents))"""
_IMG = "lower(suffix) IN ('.jpg', '.jpeg', '.png', '.webp', '.tif', '.tiff')"
_BMP = "lower(suffix) IN ('.jpg', '.jpeg', '.png', '.webp', '.tif', '.tiff', '.bmp')"


@query("scan_assets_flat", f"WITH {_INV} SELECT stem || suffix AS name, length FROM a WHERE {_IMG} AND parent = 'src3'")
def scan_flat(spark, sf):
    flat = inventory(spark, sf).where("parent = 'src3'").select(P.name(F.col("rel_path")).alias("name"), "length")
    return A.scan(flat, "name", recursive=False)


@query("scan_assets_recursive", f"WITH {_INV} SELECT rel_path, length FROM a WHERE {_BMP} AND rel_path LIKE '%.%g'")
def scan_recursive(spark, sf):
    return A.scan(inventory(spark, sf), bmp=True, pattern="%.%g").select("rel_path", "length")


@query("derive_output_path", f"""WITH {_INV} SELECT rel_path, parent || '/' || stem || '.png' AS mask_path,
    parent || '/' || stem || '_blur.jpg' AS blur_path, parent || '/' || stem || '_annot.jpg' AS annot_path FROM a WHERE {_IMG}""")
def derive_output(spark, sf):
    p = F.col("rel_path")
    return A.scan(inventory(spark, sf)).select(
        "rel_path", P.with_suffix(p, ".png").alias("mask_path"), P.with_suffix(p, "_blur.jpg").alias("blur_path"),
        P.with_suffix(p, "_annot.jpg").alias("annot_path"))


_TAGGED = f"""{_INV}, t AS (SELECT parent, CASE WHEN doc_id % 3 = 0 THEN stem || '_comfyui_carremoved'
    WHEN doc_id % 50 = 1 THEN '_comfyui_carremoved' ELSE stem END AS stem, suffix FROM a)"""


@query("suffix_strip", f"""WITH {_TAGGED} SELECT parent, stem, left(stem, length(stem) - 19) AS base FROM t
    WHERE ends_with(stem, '_comfyui_carremoved') AND length(stem) > 19""")
def suffix_strip(spark, sf):
    a = inventory(spark, sf)
    stem = (F.when(F.col("doc_id") % 3 == 0, F.concat("stem", F.lit("_comfyui_carremoved")))
            .when(F.col("doc_id") % 50 == 1, "_comfyui_carremoved").otherwise(F.col("stem")))
    t = a.select("parent", stem.alias("stem"))
    base = F.substring(F.col("stem"), F.lit(1), F.length("stem") - 19)
    return t.where(F.col("stem").endswith("_comfyui_carremoved")).withColumn("base", base).where("length(base) > 0")


@query("resume_pending", f"WITH {_INV} SELECT a.doc_id, rel_path FROM a WHERE {_IMG} AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_pending(spark, sf):
    return A.pending(A.scan(inventory(spark, sf)), done(spark, sf, "quality"), "doc_id").select("doc_id", "rel_path")


@query("resume_all_outputs", f"""WITH {_INV} SELECT doc_id FROM a WHERE {_IMG} AND NOT (
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0))""")
def resume_all(spark, sf):
    items = A.scan(inventory(spark, sf)).select("doc_id", F.explode(F.array(F.lit("quality"), F.lit("toxic"))).alias("kind"))
    labels = table(spark, sf, "labels")
    have = labels.where("quality = 1").select("doc_id", F.lit("quality").alias("kind")).unionAll(
        labels.where("toxic = 0").select("doc_id", F.lit("toxic").alias("kind")))
    key = F.concat_ws("/", "doc_id", "kind")
    return A.pending_all(items.select("doc_id", key.alias("output")), have.select(key.alias("output")), "doc_id", "output")


@query("pair_sibling", f"""WITH {_INV}, c AS (SELECT parent, 'doc_' || (doc_id - doc_id % 4) AS stem, suffix, parent || '/' || 'doc_' || (doc_id - doc_id % 4) || '_comfyui_newsky' || suffix AS rel_path FROM
      (SELECT 'src' || (doc_id - doc_id % 4) % 20 AS parent, doc_id, suffix FROM a)),
    j AS (SELECT a.rel_path, c.rel_path AS sibling, row_number() OVER (PARTITION BY a.rel_path ORDER BY
        CASE WHEN c.suffix = a.suffix THEN 0 ELSE nullif(list_position(['.jpg','.jpeg','.png','.webp','.tif','.tiff','.bmp'], c.suffix), 0) END) AS n
      FROM a JOIN c ON a.parent = c.parent AND a.stem = c.stem
      WHERE c.suffix = a.suffix OR c.suffix IN ('.jpg','.jpeg','.png','.webp','.tif','.tiff','.bmp'))
    SELECT rel_path, sibling FROM j WHERE n = 1""")
def pair_sibling(spark, sf):
    a = inventory(spark, sf)
    base = F.col("doc_id") - F.col("doc_id") % 4
    stem = F.concat(F.lit("doc_"), base)
    c = a.select(F.concat(F.lit("src"), base % 20).alias("parent"), stem.alias("stem"), "suffix").withColumn(
        "rel_path", F.concat("parent", F.lit("/"), "stem", F.lit("_comfyui_newsky"), "suffix"))
    return A.siblings(a, c)


_MASKS = """m AS (SELECT CASE WHEN doc_id % 3 = 0 THEN parent || '/' WHEN doc_id % 3 = 1 THEN '' ELSE 'other/' END
    || 'doc_' || CASE WHEN doc_id % 7 = 5 THEN doc_id - 3 ELSE doc_id END || '.png' AS rel_path FROM a WHERE doc_id % 5 <> 0)"""


@query("resolve_mask", f"""WITH {_INV}, {_MASKS}, u AS (SELECT regexp_extract(rel_path, '([^/]+)\\.png$', 1) AS stem,
      CASE WHEN count(*) = 1 THEN min(rel_path) END AS p FROM m GROUP BY 1)
    SELECT a.rel_path, coalesce(m1.rel_path, m2.rel_path, u.p) AS mask FROM a
    LEFT JOIN (SELECT DISTINCT rel_path FROM m) m1 ON m1.rel_path = a.parent || '/' || a.stem || '.png'
    LEFT JOIN (SELECT DISTINCT rel_path FROM m) m2 ON m2.rel_path = a.stem || '.png'
    LEFT JOIN u ON u.stem = a.stem""")
def resolve_mask(spark, sf):
    a = inventory(spark, sf)
    d = F.col("doc_id")
    folder = F.when(d % 3 == 0, F.concat("parent", F.lit("/"))).when(d % 3 == 1, "").otherwise("other/")
    m = a.where(d % 5 != 0).select(
        F.concat(folder, F.lit("doc_"), F.when(d % 7 == 5, d - 3).otherwise(d), F.lit(".png")).alias("rel_path"))
    return A.resolve_masks(a, m)


@query("join_mask_required", f"""WITH {_INV} SELECT rel_path, l.doc_id IS NOT NULL AS ok,
    CASE WHEN l.doc_id IS NULL THEN 'mask missing: ' || rel_path END AS error FROM a LEFT JOIN labels l USING (doc_id) WHERE {_IMG}""")
def join_mask_required(spark, sf):
    have = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("have"))
    ok = F.coalesce("have", F.lit(False))
    return A.scan(inventory(spark, sf)).join(have, "doc_id", "left").select(
        "rel_path", ok.alias("ok"), F.when(~ok, F.concat(F.lit("mask missing: "), "rel_path")).alias("error"))


@query("missing_outputs", "SELECT o_orderkey AS item FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def missing_outputs(spark, sf):
    made = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("item"))
    return A.pending(table(spark, sf, "orders").select(F.col("o_orderkey").alias("item")), made, "item")


@query("required_missing", """SELECT n_regionkey AS grp, count(*) FILTER (c IS NULL) AS missing, count(*) FILTER (c IS NULL) > 0 AS need_download
    FROM nation LEFT JOIN (SELECT DISTINCT s_nationkey AS c FROM supplier WHERE s_acctbal > 8000) ON c = n_nationkey GROUP BY 1""")
def required_missing(spark, sf):
    have = table(spark, sf, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("n_nationkey"), F.lit(1).alias("have")).distinct()
    miss = F.count_if(F.col("have").isNull())
    return table(spark, sf, "nation").join(have, "n_nationkey", "left").groupBy(F.col("n_regionkey").alias("grp")).agg(
        miss.alias("missing"), (miss > 0).alias("need_download"))


@query("conflict_anti", "SELECT DISTINCT c_nationkey AS name FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 20)")
def conflict_anti(spark, sf):
    planned = table(spark, sf, "supplier").where("s_suppkey < 20").select(F.col("s_nationkey").alias("name"))
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("name")).distinct().join(planned, "name", "left_anti")


@query("running_semi", "SELECT DISTINCT c_nationkey AS name FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 20)")
def running_semi(spark, sf):
    planned = table(spark, sf, "supplier").where("s_suppkey < 20").select(F.col("s_nationkey").alias("name"))
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("name")).distinct().join(planned, "name", "left_semi")


@query("count_images", f"""WITH {_INV}, d AS (SELECT 'src' || i AS parent FROM range(25) t(i))
    SELECT d.parent, count(a.doc_id) AS n FROM d LEFT JOIN a ON a.parent = d.parent AND {_BMP} GROUP BY 1""")
def count_images(spark, sf):
    folders = spark.range(25).select(F.concat(F.lit("src"), "id").alias("parent"))
    n = A.scan(inventory(spark, sf), bmp=True).groupBy("parent").agg(F.count("*").alias("n"))
    return folders.join(n, "parent", "left").select("parent", F.coalesce("n", F.lit(0)).alias("n"))


def _sharded(spark, sf):
    files = A.ranked(A.scan(inventory(spark, sf), bmp=True), P.sort_key(F.col("rel_path")))
    return files.withColumn("shard", A.contiguous(N_SHARDS)).withColumn("lane", A.round_robin(N_SHARDS))


_BY_PATH = "ORDER BY string_split(rel_path, '/')"
_SH = f"{_INV}, s AS (SELECT *, ntile({N_SHARDS}) OVER ({_BY_PATH}) - 1 AS shard, (row_number() OVER ({_BY_PATH}) - 1) % {N_SHARDS} AS lane FROM a WHERE {_BMP})"


@query("shard_contiguous", f"WITH {_SH} SELECT rel_path, shard FROM s")
def shard_contiguous(spark, sf):
    return _sharded(spark, sf).select("rel_path", "shard")


@query("shard_round_robin", f"WITH {_SH} SELECT rel_path, lane FROM s")
def shard_round_robin(spark, sf):
    return _sharded(spark, sf).select("rel_path", "lane")


@query("shard_counts", f"""WITH {_SH} SELECT k.i AS shard, count(s.doc_id) AS n FROM range({N_SHARDS}) k(i) LEFT JOIN s ON s.shard = k.i GROUP BY 1""")
def shard_counts(spark, sf):
    n = _sharded(spark, sf).groupBy("shard").agg(F.count("*").alias("n"))
    return spark.range(N_SHARDS).withColumnRenamed("id", "shard").join(n, "shard", "left").select("shard", F.coalesce("n", F.lit(0)).alias("n"))


#: Files of a shard share stems, and some stems look like a numbered name.
_STEM = "'doc_' || doc_id % 40 || CASE WHEN doc_id % 5 = 3 THEN '__dup001' WHEN doc_id % 11 = 4 THEN '__dup001__dup001' ELSE '' END"
_FLAT = f"""{_SH}, f AS MATERIALIZED (SELECT lane AS shard, rel_path, {_STEM} AS stem, lower(suffix) AS suffix,
      row_number() OVER (PARTITION BY lane {_BY_PATH}, rel_path) AS k FROM s),
    r(shard, k, rel_path, dst, taken) AS (
      SELECT DISTINCT shard, 0::BIGINT, ''::VARCHAR, ''::VARCHAR, []::VARCHAR[] FROM f
      UNION ALL
      SELECT shard, k, rel_path, dst, list_append(taken, dst) FROM (
        SELECT f.shard, f.k, f.rel_path, r.taken, list_filter(
          list_transform(range(0, f.k), lambda n: f.stem || CASE WHEN n > 0 THEN '__dup' || lpad(n::VARCHAR, 3, '0') ELSE '' END || f.suffix),
          lambda x: NOT list_contains(r.taken, x))[1] AS dst
        FROM r JOIN f ON f.shard = r.shard AND f.k = r.k + 1)),
    n AS (SELECT shard, rel_path, dst FROM r WHERE k > 0)"""


@query("dup_rename", f"WITH RECURSIVE {_FLAT} SELECT rel_path, shard, dst AS dst_name FROM n")
def dup_rename(spark, sf):
    d = F.col("doc_id")
    mark = F.when(d % 5 == 3, "__dup001").when(d % 11 == 4, "__dup001__dup001").otherwise("")
    f = _sharded(spark, sf).select(F.col("lane").alias("shard"), "rel_path", F.concat(F.lit("doc_"), d % 40, mark).alias("stem"), "suffix")
    return A.renamed(f).select("rel_path", "shard", "dst_name")


@query("shard_manifest", f"""WITH RECURSIVE {_FLAT} SELECT '/in/' || rel_path AS src, '/shards/' || shard || '/' || dst AS dst, shard AS shard_index, dst AS dst_name FROM n""")
def shard_manifest(spark, sf):
    return dup_rename(spark, sf).select(
        F.concat(F.lit("/in/"), "rel_path").alias("src"), F.concat(F.lit("/shards/"), "shard", F.lit("/"), "dst_name").alias("dst"),
        F.col("shard").alias("shard_index"), "dst_name")


@query("stage_plan", f"""WITH {_INV} SELECT rel_path, CASE WHEN l.doc_id IS NULL THEN 'copy' WHEN quality = 1 THEN 'same' ELSE 'replace' END AS action
    FROM a LEFT JOIN labels l USING (doc_id) WHERE {_IMG}""")
def stage_plan(spark, sf):
    l = table(spark, sf, "labels").select("doc_id", "quality")
    action = F.when(F.col("quality").isNull(), "copy").when(F.col("quality") == 1, "same").otherwise("replace")
    return A.scan(inventory(spark, sf)).join(l, "doc_id", "left").select("rel_path", action.alias("action"))


@query("publish_union", f"""WITH {_SH} SELECT 'gpu' || lane || '/' || rel_path AS target, lane AS gpu, rel_path FROM s""")
def publish_union(spark, sf):
    """The files of all lanes, each below its lane's folder."""
    return _sharded(spark, sf).select(
        F.concat(F.lit("gpu"), "lane", F.lit("/"), "rel_path").alias("target"), F.col("lane").alias("gpu"), "rel_path")


_NEST = f"{_INV}, p AS (SELECT parent, replace(parent, 'src', 'src' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '-' END) || '/' || stem AS path FROM a)"


@query("path_sort", f"WITH {_NEST} SELECT path, row_number() OVER (PARTITION BY parent ORDER BY string_split(path, '/')) AS place FROM p")
def path_sort(spark, sf):
    a = inventory(spark, sf)
    dash = F.when(F.col("doc_id") % 2 == 0, "").otherwise("-")
    p = a.select("parent", F.concat(F.replace(F.col("parent"), F.lit("src"), F.concat(F.lit("src"), dash)), F.lit("/"), "stem").alias("path"))
    return p.select("path", F.row_number().over(Window.partitionBy("parent").orderBy(P.sort_key(F.col("path")))).alias("place"))


@query("limit_inputs", f"WITH {_INV} SELECT rel_path FROM a WHERE {_IMG} ORDER BY string_split(rel_path, '/') LIMIT 25")
def limit_inputs(spark, sf):
    """The feature itself is a limit: the first 25 inputs in path order."""
    return A.scan(inventory(spark, sf)).orderBy(P.sort_key(F.col("rel_path"))).select("rel_path").limit(25)


@query("error_sample", f"""WITH {_INV}, e AS (SELECT parent, 'missing: ' || rel_path AS error, row_number() OVER (PARTITION BY parent ORDER BY rel_path) AS n
      FROM a WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    SELECT parent, count(*) AS n_errors, list(error ORDER BY n) FILTER (n <= 20) AS sample,
           CASE WHEN count(*) > 20 THEN '... and ' || (count(*) - 20) || ' more' ELSE '' END AS rest FROM e GROUP BY parent""")
def error_sample(spark, sf):
    bad = A.pending(inventory(spark, sf), table(spark, sf, "labels"), "doc_id")
    e = bad.select("parent", F.concat(F.lit("missing: "), "rel_path").alias("error"))
    e = e.withColumn("n", F.row_number().over(Window.partitionBy("parent").orderBy("error")))
    more = F.count("*") - 20
    return e.groupBy("parent").agg(
        F.count("*").alias("n_errors"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("n") <= 20, F.struct("n", "error")))), lambda s: s["error"]).alias("sample"),
        F.when(more > 0, F.concat(F.lit("... and "), more, F.lit(" more"))).otherwise("").alias("rest"))


_KV = "split_part(split_part(url, '?', 2), '#', 1)"


@query("kv_parse", f"""WITH i AS (SELECT page_id, unnest(string_split({_KV}, '&')) AS item FROM pages WHERE contains(url, '?'))
    SELECT page_id, left(item, strpos(item, '=') - 1) AS k, substr(item, strpos(item, '=') + 1) AS v FROM i WHERE contains(item, '=')""")
def kv_parse(spark, sf):
    raw = F.split_part(F.split_part("url", F.lit("?"), F.lit(2)), F.lit("#"), F.lit(1))
    items = table(spark, sf, "pages").where(F.col("url").contains("?")).select("page_id", F.explode(F.split(raw, "&")).alias("item"))
    k, v = S.split_pair(F.col("item"))
    return items.select("page_id", k.alias("k"), v.alias("v")).where("k is not null")


@query("split_id_list", r"""SELECT event_id, list_filter(string_split_regex(event_type || ', ' || user_id || ',,' || event_id, '[, ]'), lambda x: x <> '') AS ids FROM events""")
def split_id_list(spark, sf):
    raw = F.concat("event_type", F.lit(", "), "user_id", F.lit(",,"), "event_id")
    return table(spark, sf, "events").select("event_id", S.split_list(raw).alias("ids"))


@query("parse_strict", """SELECT event_id, lower(trim(f)) NOT IN ('0', 'false', 'no', 'off') AS strict FROM (SELECT event_id,
    list_extract([' 0 ', 'False', 'NO', 'off', 'yes', '1', ''], CAST(event_id % 7 AS INT) + 1) AS f FROM events)""")
def parse_strict(spark, sf):
    words = F.array(*[F.lit(x) for x in (" 0 ", "False", "NO", "off", "yes", "1", "")])
    f = F.element_at(words, (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", S.parse_strict(f).alias("strict"))


_VALUES = ("TRUE", "null", "0", "1_000", " 7 ", "1e3", "nan", "0,1", "abc", "5d", "-12", "2.50")


@query("coerce_scalar", f"""SELECT event_id, list_extract(['bool','null','int','int','int','float','float','str','str','str','int','float'], i) AS kind,
    list_extract(['true','null','0','1000','7','1000.0','nan','0,1','abc','5d','-12','2.5'], i) AS value
    FROM (SELECT event_id, CAST(event_id % {len(_VALUES)} AS INT) + 1 AS i FROM events)""")
def coerce_scalar(spark, sf):
    raw = F.element_at(F.array(*[F.lit(x) for x in _VALUES]), (F.col("event_id") % len(_VALUES) + 1).cast("int"))
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", S.scalar_type(F.col("raw")).alias("kind"), S.scalar_text(F.col("raw")).alias("value"))
