"""Queries on detections: lineitem rows stand for detected boxes on 1000 x 600 faces."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scaling import PREFERRED
from ..operators import boxes as B
from .base import query, table

W, H = 1000, 600
FACES = ("F", "R", "B", "L")


def detections(spark, sf):
    l = table(spark, sf, "lineitem")
    x1 = F.col("l_quantity") * 20.5 - 30.25
    y1 = F.col("l_tax") * 6000 - 10.5
    face = F.element_at(F.array(*[F.lit(f) for f in FACES]), F.col("l_linenumber") % 4 + 1)
    return l.select(
        F.col("l_orderkey").alias("image"), "l_linenumber", face.alias("face"), x1.alias("x1"), y1.alias("y1"),
        (x1 + F.col("l_extendedprice") / 300).alias("x2"), (y1 + F.col("l_quantity") * 3.5).alias("y2"),
        F.round(F.col("l_discount") * 10, 2).alias("conf"), F.when(F.col("l_linestatus") == "F", "F").otherwise("LP").alias("typ"))


_DET = f"""d AS (SELECT l_orderkey AS image, l_linenumber, list_extract({list(FACES)}, CAST(l_linenumber % 4 AS INT) + 1) AS face,
    l_quantity * 20.5::DOUBLE - 30.25::DOUBLE AS x1, l_tax * 6000::DOUBLE - 10.5::DOUBLE AS y1,
    (l_quantity * 20.5::DOUBLE - 30.25::DOUBLE) + l_extendedprice / 300::DOUBLE AS x2,
    (l_tax * 6000::DOUBLE - 10.5::DOUBLE) + l_quantity * 3.5::DOUBLE AS y2,
    round(l_discount * 10, 2) AS conf, CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'LP' END AS typ FROM lineitem)"""


def _clip_sql(f: str, kind: str, name: str) -> str:
    one = lambda c: f.format(c)
    return f"""{name} AS (SELECT * FROM (SELECT image, l_linenumber, face, conf, typ,
        greatest(0, least({one('x1')}, {W - 1})) AS x1, greatest(0, least({one('y1')}, {H - 1})) AS y1,
        greatest(0, least({one('x2')}, {W})) AS x2, greatest(0, least({one('y2')}, {H})) AS y2 FROM d WHERE typ = '{kind}') WHERE x2 > x1 AND y2 > y1)"""


_FACE = _clip_sql("CAST(round_even({}, 0) AS INT)", "F", "f")
_LP = _clip_sql("CAST(trunc({}) AS INT)", "LP", "p")
_ALL = f"{_DET}, {_FACE}, {_LP}, u AS (SELECT * FROM f UNION ALL SELECT * FROM p)"
_COLS = "image, l_linenumber, face, conf, typ, x1, y1, x2, y2"


def faces(spark, sf):
    return B.clipped(detections(spark, sf).where("typ = 'F'"), W, H, rounding=True)


def plates(spark, sf):
    return B.clipped(detections(spark, sf).where("typ = 'LP'"), W, H, rounding=False)


def both(spark, sf):
    return faces(spark, sf).unionByName(plates(spark, sf))


@query("box_clip_face", f"WITH {_DET}, {_FACE} SELECT {_COLS} FROM f")
def box_clip_face(spark, sf):
    return faces(spark, sf)


@query("box_clip_lp", f"WITH {_DET}, {_LP} SELECT {_COLS} FROM p")
def box_clip_lp(spark, sf):
    return plates(spark, sf)


#: Least confidence by the kind of box.
LEAST_CONF = {"F": 0.4, "LP": 0.4}


@query("box_conf_filter", f"WITH {_DET} SELECT image, l_linenumber, typ, conf FROM d WHERE conf >= CASE typ WHEN 'F' THEN {LEAST_CONF['F']} ELSE {LEAST_CONF['LP']} END")
def box_conf_filter(spark, sf):
    return B.confident(detections(spark, sf), LEAST_CONF).select("image", "l_linenumber", "typ", "conf")


@query("detections_union", f"WITH {_ALL} SELECT {_COLS} FROM u")
def detections_union(spark, sf):
    return both(spark, sf)


@query("boxes_per_image", f"""WITH {_ALL} SELECT image, count(*) FILTER (typ = 'F') AS face_boxes, count(*) FILTER (typ = 'LP') AS lp_boxes,
    count(*) AS total_boxes FROM u GROUP BY image""")
def boxes_per_image(spark, sf):
    return B.per_image(both(spark, sf))


@query("annot_labels", f"WITH {_ALL} SELECT image, l_linenumber, printf('%s %.2f', typ, conf) AS label FROM u")
def annot_labels(spark, sf):
    return B.labels(both(spark, sf)).select("image", "l_linenumber", "label")


@query("roi_boxes", f"""WITH {_ALL} SELECT image, l_linenumber, greatest(x1 - 24, 0) AS x1, greatest(y1 - 24, 0) AS y1,
    least(x2 + 24, {W}) AS x2, least(y2 + 24, {H}) AS y2 FROM u WHERE (x2 - x1) * (y2 - y1) >= 64""")
def roi_boxes(spark, sf):
    return B.regions(both(spark, sf), W, H, 24, 64).select("image", "l_linenumber", "x1", "y1", "x2", "y2")


@query("box_rasterize", f"""WITH {_ALL}, g AS (SELECT i % 10 AS cx, i // 10 AS cy FROM range(60) t(i))
    SELECT DISTINCT image, face, CAST(cx AS INT) AS cx, CAST(cy AS INT) AS cy FROM u JOIN g
    ON x1 < (cx + 1) * 100 AND x2 > cx * 100 AND y1 < (cy + 1) * 100 AND y2 > cy * 100""")
def box_rasterize(spark, sf):
    return B.rasterized(both(spark, sf), 100)


@query("cube_mask_faces", f"""WITH {_ALL}, i AS (SELECT DISTINCT image FROM u), k AS (SELECT image, face FROM i, (SELECT unnest(['F','R','B','L','U','D']) AS face))
    SELECT k.image, k.face, count(u.typ) AS n_boxes, count(u.typ) = 0 AS zero FROM k LEFT JOIN u ON u.image = k.image AND u.face = k.face GROUP BY 1, 2""")
def cube_mask_faces(spark, sf):
    u = both(spark, sf)
    keys = u.select("image").distinct().select("image", F.explode(F.array(*[F.lit(f) for f in "FRBLUD"])).alias("face"))
    n = u.groupBy("image", "face").agg(F.count("*").alias("n"))
    n_boxes = F.coalesce("n", F.lit(0))
    return keys.join(n, ["image", "face"], "left").select("image", "face", n_boxes.alias("n_boxes"), (n_boxes == 0).alias("zero"))


@query("boxes_sidecar", f"""WITH {_ALL} SELECT 'in/' || image || '.jpg' AS input, 'out/' || image || '.jpg' AS output,
    list([x1, y1, x2, y2] ORDER BY l_linenumber, [x1, y1, x2, y2]) AS boxes_xyxy, round(sum(conf), 2) AS seconds FROM u GROUP BY image""")
def boxes_sidecar(spark, sf):
    box = F.array("x1", "y1", "x2", "y2")
    rows = both(spark, sf).groupBy("image").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", box.alias("b")))).alias("s"), F.round(F.sum("conf"), 2).alias("seconds"))
    return rows.select(
        F.concat(F.lit("in/"), "image", F.lit(".jpg")).alias("input"), F.concat(F.lit("out/"), "image", F.lit(".jpg")).alias("output"),
        F.transform("s", lambda s: s["b"]).alias("boxes_xyxy"), "seconds")


@query("image_summary", f"""WITH {_ALL} SELECT image, count(*) FILTER (typ = 'F') AS face_boxes, count(*) FILTER (typ = 'LP') AS lp_boxes,
    count(*) AS total_boxes, printf('%.6f', round(sum(conf), 2)) AS elapsed_sec FROM u GROUP BY image""")
def image_summary(spark, sf):
    u = both(spark, sf)
    sec = u.groupBy("image").agg(F.format_string("%.6f", F.round(F.sum("conf"), 2)).alias("elapsed_sec"))
    return B.per_image(u).join(sec, "image")


@query("image_profile", """SELECT l_orderkey AS image, printf('%.6f', round(sum(l_tax), 4)) AS read_sec, printf('%.6f', round(sum(l_discount), 4)) AS detect_sec,
    printf('%.6f', round(sum(l_tax) + sum(l_discount), 4)) AS total_sec FROM lineitem GROUP BY 1""")
def image_profile(spark, sf):
    show = lambda c: F.format_string("%.6f", F.round(c, 4))
    tax, dis = F.sum("l_tax"), F.sum("l_discount")
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(
        show(tax).alias("read_sec"), show(dis).alias("detect_sec"), show(tax + dis).alias("total_sec"))


@query("privacy_summary", f"""WITH {_ALL}, i AS (SELECT image, count(*) FILTER (typ = 'F') AS f, count(*) FILTER (typ = 'LP') AS p, sum(conf) AS s FROM u GROUP BY image)
    SELECT count(*) AS images, sum(f)::BIGINT AS faces, sum(p)::BIGINT AS plates, round(sum(s), 4) AS elapsed,
           CASE WHEN count(*) > 0 THEN round(sum(s) / count(*), 6) ELSE 0 END AS avg_elapsed FROM i""")
def privacy_summary(spark, sf):
    i = both(spark, sf).groupBy("image").agg(
        F.count_if(F.col("typ") == "F").alias("f"), F.count_if(F.col("typ") == "LP").alias("p"), F.sum("conf").alias("s"))
    n = F.count("*")
    return i.agg(
        n.alias("images"), F.sum("f").alias("faces"), F.sum("p").alias("plates"), F.round(F.sum("s"), 4).alias("elapsed"),
        F.when(n > 0, F.round(F.sum("s") / n, 6)).otherwise(0.0).alias("avg_elapsed"))


@query("tile_windows", """WITH d AS (SELECT p_partkey AS id, 1000 + p_size * 40 AS w, 500 + p_size * 20 AS h FROM part),
    g AS (SELECT d.*, c, w // 3 AS tx, h // 2 AS ty, r FROM d, range(3) a(c), range(2) b(r)),
    o AS (SELECT *, least(tx // 2, CAST(floor(tx * 0.05::DOUBLE) AS INT) + 30) AS ox, least(ty // 2, CAST(floor(ty * 0.05::DOUBLE) AS INT) + 30) AS oy FROM g),
    s AS (SELECT *, greatest(0, c * tx - CASE WHEN c > 0 THEN ox ELSE 0 END) AS sx, greatest(0, r * ty - CASE WHEN r > 0 THEN oy ELSE 0 END) AS sy FROM o),
    e AS (SELECT *, greatest(0, sx + tx + ox - w) AS bx, greatest(0, sy + ty + oy - h) AS by_ FROM s)
    SELECT id, w, h, CAST(r * 3 + c AS INT) AS i, greatest(0, sx - bx) AS x1, greatest(0, sy - by_) AS y1, sx + tx + ox - bx AS x2, sy + ty + oy - by_ AS y2 FROM e""")
def tile_windows(spark, sf):
    dims = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (1000 + F.col("p_size") * 40).alias("w"), (500 + F.col("p_size") * 20).alias("h"))
    return B.tile_windows(dims, 2, 3, 0.05, 30)


@query("aspect_crop_box", """WITH d AS (SELECT p_partkey AS id, 400 + p_size * 17 AS w, 300 + CAST(p_partkey % 500 AS INT) AS h, 640 + p_size AS tw, 320 + p_size * 3 AS th FROM part),
    r AS (SELECT *, w::DOUBLE / h AS mr, tw::DOUBLE / th AS tr FROM d),
    c AS (SELECT *, CASE WHEN mr - tr > 1e-6 THEN CAST(round_even(h * tr, 0) AS INT) ELSE w END AS cw, CASE WHEN tr - mr > 1e-6 THEN CAST(round_even(w / tr, 0) AS INT) ELSE h END AS ch FROM r)
    SELECT id, greatest(0, (w - cw) // 2) AS x0, greatest(0, (h - ch) // 2) AS y0, cw, ch, tw, th FROM c""")
def aspect_crop_box(spark, sf):
    """The centred crop of a mask to the aspect of its target, and the target's size to which it is then resized."""
    d = table(spark, sf, "part").selectExpr(
        "p_partkey AS id", "400 + p_size * 17 AS w", "300 + p_partkey % 500 AS h", "640 + p_size AS tw", "320 + p_size * 3 AS th")
    return B.aspect_crop(d)


@query("preferred_crop", f"""WITH d AS (SELECT p_partkey AS id, 400 + p_size * 37 AS w, 300 + CAST(p_partkey % 900 AS INT) AS h FROM part),
    s(tw, th) AS (VALUES {", ".join(map(str, PREFERRED))}),
    n AS (SELECT id, w, h, tw, th FROM d, s QUALIFY row_number() OVER (PARTITION BY id ORDER BY abs(w::DOUBLE / h - tw::DOUBLE / th), tw) = 1),
    c AS (SELECT *, CASE WHEN w * th > tw * h THEN CAST(round_even((w - h * tw::DOUBLE / th) / 2, 0) AS INT) ELSE 0 END AS x0, CASE WHEN w * th > tw * h THEN 0 ELSE CAST(round_even((h - w * th::DOUBLE / tw) / 2, 0) AS INT) END AS y0 FROM n)
    SELECT id, x0, y0, CAST(w - 2 * x0 AS INT) AS cw, CAST(h - 2 * y0 AS INT) AS ch, tw, th FROM c""")
def preferred_crop(spark, sf):
    """The middle of each image that is resized to the size that an editing model prefers for its shape."""
    return B.preferred_crop(table(spark, sf, "part").selectExpr("p_partkey AS id", "400 + p_size * 37 AS w", "int(300 + p_partkey % 900) AS h"))


@query("top1_component", f"""WITH {_ALL}, r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY (x2 - x1) * (y2 - y1) DESC, l_linenumber) AS n FROM u)
    SELECT image, l_linenumber, (x2 - x1) * (y2 - y1) AS area FROM r WHERE n = 1""")
def top1_component(spark, sf):
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    u = both(spark, sf).withColumn("area", area)
    best = F.max_by(F.struct("l_linenumber", "area"), F.struct("area", -F.col("l_linenumber")))
    return u.groupBy("image").agg(best.alias("b")).select("image", "b.l_linenumber", "b.area")


_NMS = 0.3


@query("box_nms", f"""WITH RECURSIVE {_DET}, s AS (SELECT image, face, l_linenumber, conf, typ, x1, y1, x2, y2 FROM d WHERE x2 > x1 AND y2 > y1),
    r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image, typ ORDER BY conf DESC, x1, y1, x2, y2, l_linenumber) AS k FROM s),
    n(image, typ, k, kept) AS (
      SELECT DISTINCT image, typ, 0::BIGINT, []::STRUCT(k BIGINT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[] FROM r
      UNION ALL
      SELECT r.image, r.typ, r.k, CASE WHEN len(list_filter(kept, lambda o: i_of(o.x1, o.y1, o.x2, o.y2, r.x1, r.y1, r.x2, r.y2) > {_NMS})) > 0 THEN kept
        ELSE list_append(kept, {{'k': r.k, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END
      FROM n JOIN r ON r.image = n.image AND r.typ = n.typ AND r.k = n.k + 1),
    f AS (SELECT image, typ, unnest(list_transform(kept, lambda o: o.k)) AS k FROM n QUALIFY row_number() OVER (PARTITION BY image, typ ORDER BY n.k DESC) = 1)
    SELECT r.image, r.typ, l_linenumber, conf FROM r JOIN f USING (image, typ, k)""".replace(
        "i_of(o.x1, o.y1, o.x2, o.y2, r.x1, r.y1, r.x2, r.y2)",
        "(greatest(0, least(o.x2, r.x2) - greatest(o.x1, r.x1)) * greatest(0, least(o.y2, r.y2) - greatest(o.y1, r.y1))) / ((o.x2 - o.x1) * (o.y2 - o.y1) + (r.x2 - r.x1) * (r.y2 - r.y1)"
        " - greatest(0, least(o.x2, r.x2) - greatest(o.x1, r.x1)) * greatest(0, least(o.y2, r.y2) - greatest(o.y1, r.y1)))"))
def box_nms(spark, sf):
    """Of the boxes of an image and kind those that no better one covers by more than 0.3."""
    d = detections(spark, sf).where("x2 > x1 AND y2 > y1")
    out = B.suppressed(d, ["image", "typ"], _NMS, ["x1", "y1", "x2", "y2", "l_linenumber"])
    return out.select("image", "typ", "l_linenumber", "conf")
