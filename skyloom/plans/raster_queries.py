"""Queries on rasters: each embedding stands for an 8 x 8 image with values in [0, 1]."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import scaling, sphere
from ..operators import raster as R
from ..sources import images as I
from .base import query, table

N = 8
#: Where values are compared between engines.
DIGITS = 6


def pixels(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("img"), F.posexplode("embedding").alias("i", "e"))
    return e.select("img", F.floor(F.col("i") / N).cast("int").alias("y"), (F.col("i") % N).alias("x"), ((F.col("e").cast("double") + 1) / 2).alias("v"))


def partner(px):
    """The transposed image, as the second raster."""
    return px.select("img", F.col("x").alias("y"), F.col("y").alias("x"), "v")


def bright(px):
    return px.withColumn("v", F.when(F.col("v") >= 0.5, 1.0).otherwise(0.0))


def whole(spark, sf, kernel):
    """Pixels (level, img, y, x, v) of the rasters that ``kernel`` makes of each image, one image a row."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("img"), F.col("embedding").cast("array<float>").alias("e"))
    return e.mapInArrow(K.each_embedding(N, kernel), "level int, img long, y int, x int, v double")


def shown(px, name="v"):
    return px.select("img", "y", "x", (F.round("v", DIGITS) + 0.0).alias(name))


_PX = f"""px AS MATERIALIZED (SELECT vec_id AS img, CAST(i // {N} AS INT) AS y, CAST(i % {N} AS INT) AS x, (embedding[i + 1]::DOUBLE + 1) / 2 AS v
    FROM embeddings, range({N * N}) t(i))"""
_PT = "pt AS MATERIALIZED (SELECT img, x AS y, y AS x, v FROM px)"
_MK = "mk AS MATERIALIZED (SELECT img, y, x, CASE WHEN v >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v FROM px)"


def _out(rel: str) -> str:
    return f"SELECT img, y, x, round(v, {DIGITS}) + 0.0 AS v FROM {rel}"


def _ext(src: str, name: str, fn: str, r: int) -> str:
    return f"""{name}_x AS (SELECT img, y, x, {fn}(v) OVER (PARTITION BY img, y ORDER BY x ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS v FROM {src}),
    {name} AS (SELECT img, y, x, {fn}(v) OVER (PARTITION BY img, x ORDER BY y ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS v FROM {name}_x)"""


def _taps(kernel) -> str:
    return "(VALUES " + ", ".join(f"({d}, {k!r}::DOUBLE)" for d, k in kernel) + ") k(d, w)"


def _mirror(i: str, n: int) -> str:
    p = max(1, 2 * (n - 1))
    m = f"((({i}) % {p} + {p}) % {p})"
    return f"(CASE WHEN {m} < {n} THEN {m} ELSE {2 * (n - 1)} - {m} END)"


def _blur(src: str, name: str, kernel, n: int) -> str:
    return f"""{name}_x AS MATERIALIZED (SELECT p.img, p.y, p.x, sum(q.v * k.w) AS v FROM {src} p, {_taps(kernel)}, {src} q
      WHERE q.img = p.img AND q.y = p.y AND q.x = {_mirror('p.x + k.d', n)} GROUP BY 1, 2, 3),
    {name} AS MATERIALIZED (SELECT p.img, p.y, p.x, sum(q.v * k.w) AS v FROM {name}_x p, {_taps(kernel)}, {name}_x q
      WHERE q.img = p.img AND q.x = p.x AND q.y = {_mirror('p.y + k.d', n)} GROUP BY 1, 2, 3)"""


def _half(src: str, name: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT img, CAST(y // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, avg(v) AS v FROM {src} GROUP BY 1, 2, 3 HAVING count(*) = 4)"


def _up(src: str, name: str, n: int, to: int) -> str:
    g = f"""(SELECT CAST(d AS INT) AS d, CAST(least(floor(s), {n - 1}) AS INT) AS i, CAST(least(floor(s) + 1, {n - 1}) AS INT) AS j, s - floor(s) AS f
       FROM (SELECT d, greatest(0.0::DOUBLE, (d + 0.5::DOUBLE) * {n / to!r}::DOUBLE - 0.5::DOUBLE) AS s FROM range({to}) t(d))) g"""
    return f"""{name}_x AS (SELECT a.img, a.y, g.d AS x, a.v * (1 - g.f) + b.v * g.f AS v FROM {g} JOIN {src} a ON a.x = g.i
      JOIN {src} b ON b.img = a.img AND b.y = a.y AND b.x = g.j),
    {name} AS MATERIALIZED (SELECT a.img, g.d AS y, a.x, a.v * (1 - g.f) + b.v * g.f AS v FROM {g} JOIN {name}_x a ON a.y = g.i
      JOIN {name}_x b ON b.img = a.img AND b.x = a.x AND b.y = g.j)"""


_R2 = R.kernel_of_radius(2)


def _pyramid(src: str, p: str) -> str:
    """Three levels of sides 8, 4, 2 (p0, p1, p2) and their Laplacians (p0l, p1l, and p2 itself)."""
    return ", ".join([
        f"{p}0 AS (SELECT * FROM {src})", _blur(f"{p}0", f"{p}0b", _R2, 8), _half(f"{p}0b", f"{p}1"), _blur(f"{p}1", f"{p}1b", _R2, 4),
        _half(f"{p}1b", f"{p}2"), _up(f"{p}1", f"{p}1u", 4, 8), _up(f"{p}2", f"{p}2u", 2, 4),
        f"{p}0l AS (SELECT img, y, x, a.v - b.v AS v FROM {p}0 a JOIN {p}1u b USING (img, y, x))",
        f"{p}1l AS (SELECT img, y, x, a.v - b.v AS v FROM {p}1 a JOIN {p}2u b USING (img, y, x))"])


def _collapse(l0: str, l1: str, l2: str, c: str) -> str:
    return ", ".join([
        _up(l2, f"{c}a", 2, 4), f"{c}b AS (SELECT img, y, x, a.v + b.v AS v FROM {c}a a JOIN {l1} b USING (img, y, x))",
        _up(f"{c}b", f"{c}c", 4, 8), f"{c} AS (SELECT img, y, x, a.v + b.v AS v FROM {c}c a JOIN {l0} b USING (img, y, x))"])


@query("dilate3x3", f"WITH {_PX}, {_ext('px', 'o', 'max', 1)} {_out('o')}")
def dilate3x3(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.extreme(a, 1)]))


@query("erode_kxk", f"WITH {_PX}, {_ext('px', 'o', 'min', 2)} {_out('o')}")
def erode_kxk(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.extreme(a, 2, np.minimum)]))


@query("gaussian_kernel", """SELECT p_partkey AS id, d, round(w / sum(w) OVER (PARTITION BY p_partkey), 9) AS w FROM (
      SELECT p_partkey, CAST(o AS INT) AS d, CASE WHEN r < 0.5 THEN 1 ELSE exp(-(o * o) / (2 * r * r)) END AS w
      FROM (SELECT p_partkey, p_size / 6.0::DOUBLE AS r FROM part), range(-9, 10) t(o) WHERE abs(o) <= CASE WHEN r < 0.5 THEN 0 ELSE floor(r) END)""")
def gaussian_kernel(spark, sf):
    """The taps of each part's radius, a sixth of its size."""
    r = (F.col("p_size") / 6.0).alias("r")
    taps = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.explode(R.radius_taps(r)).alias("t"))
    return taps.select("id", "t.d", F.round("t.w", 9).alias("w"))


@query("gauss_radius", f"WITH {_PX}, {_blur('px', 'o', _R2, N)} {_out('o')}")
def gauss_radius(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.convolve(a, _R2)]))


_SIG = R.kernel_of_sigma(0.9)


@query("gauss_sigma", f"WITH {_PX}, {_blur('px', 'o', _SIG, N)} {_out('o')}")
def gauss_sigma(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.convolve(a, _SIG)]))


@query("downsample2", f"WITH {_PX}, {_half('px', 'o')} {_out('o')}")
def downsample2(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.halve(a)]))


@query("upsample_bilinear", f"WITH {_PX}, {_up('px', 'o', 8, 12)} {_out('o')}")
def upsample_bilinear(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.resize(a, 12, 12)]))


@query("gauss_pyramid", f"WITH {_PX}, {_pyramid('px', 'g')} SELECT 1 AS level, img, y, x, round(v, 6) + 0.0 AS v FROM g1 UNION ALL SELECT 2, img, y, x, round(v, 6) + 0.0 FROM g2")
def gauss_pyramid(spark, sf):
    g = whole(spark, sf, lambda a: K.gaussian_pyramid(a, _R2, 2)).where("level > 0")
    return g.select("level", "img", "y", "x", (F.round("v", DIGITS) + 0.0).alias("v"))


@query("lap_pyramid", f"WITH {_PX}, {_pyramid('px', 'g')} SELECT 0 AS level, img, y, x, round(v, 6) + 0.0 AS v FROM g0l UNION ALL SELECT 1, img, y, x, round(v, 6) + 0.0 FROM g1l UNION ALL SELECT 2, img, y, x, round(v, 6) + 0.0 FROM g2")
def lap_pyramid(spark, sf):
    g = whole(spark, sf, lambda a: K.laplacian_pyramid(a, _R2, 2))
    return g.select("level", "img", "y", "x", (F.round("v", DIGITS) + 0.0).alias("v"))


@query("lap_roundtrip", f"WITH {_PX} {_out('px')}")
def lap_roundtrip(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.collapse(K.laplacian_pyramid(a, _R2, 2))]))


_LB = ", ".join([
    _PX, _PT, _MK, _pyramid("px", "b"), _pyramid("pt", "s"), _pyramid("mk", "m"),
    *[f"{o} AS (SELECT img, y, x, s.v * m.v + b.v * (1 - m.v) AS v FROM {b} b JOIN {s} s USING (img, y, x) JOIN {m} m USING (img, y, x))"
      for o, b, s, m in (("n0", "b0l", "s0l", "m0"), ("n1", "b1l", "s1l", "m1"), ("n2", "b2", "s2", "m2"))],
    _collapse("n0", "n1", "n2", "c")])


@query("laplacian_blend", f"WITH {_LB} SELECT img, y, x, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, v)), 6) + 0.0 AS v FROM c")
def laplacian_blend(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.laplacian_blend(a, a.T, (a >= 0.5) * 1.0, _R2, 2)]))


@query("alpha_blend", f"""SELECT img, y, x, round(a * (1 - b) + (1 - a) * b, 6) + 0.0 AS v FROM (SELECT vec_id AS img, CAST(i // {N} AS INT) AS y, CAST(i % {N} AS INT) AS x,
    (embedding[i + 1]::DOUBLE + 1) / 2 AS a, (embedding[i % {N} * {N} + i // {N} + 1]::DOUBLE + 1) / 2 AS b FROM embeddings, range({N * N}) t(i))""")
def alpha_blend(spark, sf):
    return shown(whole(spark, sf, lambda a: [a * (1 - a.T) + (1 - a) * a.T]))


_FEATHER = R.kernel_of_feather(1)


@query("feather_blend", f"""WITH {_PX}, {_MK}, {_ext('mk', 'er', 'min', 1)}, {_blur('er', 'al', _FEATHER, N)}
    SELECT img, y, x, round((embedding[y * {N} + x + 1]::DOUBLE + 1) / 2 * (1 - al.v) + (embedding[x * {N} + y + 1]::DOUBLE + 1) / 2 * al.v, 6) + 0.0 AS v FROM al JOIN embeddings ON vec_id = img""")
def feather_blend(spark, sf):
    def blend(a):
        alpha = K.feather((a >= 0.5) * 1.0, 1, _FEATHER)
        return [a * (1 - alpha) + a.T * alpha]

    return shown(whole(spark, sf, blend))


@query("full_blur", f"""WITH {_PX}, {_blur('px', 'bl', _SIG, N)}
    SELECT img, y, x, round(CASE WHEN embedding[y * {N} + x + 1] >= 0 THEN bl.v ELSE (embedding[y * {N} + x + 1]::DOUBLE + 1) / 2 END, 6) + 0.0 AS v FROM bl JOIN embeddings ON vec_id = img""")
def full_blur(spark, sf):
    return shown(whole(spark, sf, lambda a: [np.where(a >= 0.5, K.convolve(a, _SIG), a)]))


@query("mask_threshold", f"""WITH {_PX} SELECT img, y, x, CASE WHEN floor(v * 255) >= 127 THEN 255 ELSE 0 END AS hard, CASE WHEN floor(v * 255) > 0 THEN 255 ELSE 0 END AS any_,
    CASE WHEN v >= 0.35 THEN 1 ELSE 0 END AS soft FROM px""")
def mask_threshold(spark, sf):
    u8 = F.floor(F.col("v") * 255)
    return pixels(spark, sf).select(
        "img", "y", "x", F.when(u8 >= 127, 255).otherwise(0).alias("hard"), F.when(u8 > 0, 255).otherwise(0).alias("any_"),
        F.when(F.col("v") >= 0.35, 1).otherwise(0).alias("soft"))


@query("orient_mask", f"""WITH {_PX}, t AS (SELECT img, avg(v) FILTER (y < 2) AS t, avg(v) FILTER (y >= 5) AS b FROM px GROUP BY img)
    SELECT img, y, x, round(CASE WHEN t < b THEN 1 - v ELSE v END, 6) + 0.0 AS v FROM px JOIN t USING (img)""")
def orient_mask(spark, sf):
    def turned(a):
        return [1 - a if a[: max(1, N // 3)].mean() < a[2 * N // 3 :].mean() else a]

    return shown(whole(spark, sf, turned))


@query("mask_union", f"WITH {_PX} SELECT CAST(img // 4 AS BIGINT) AS img, y, x, round(max(v), 6) + 0.0 AS v FROM px GROUP BY 1, 2, 3")
def mask_union(spark, sf):
    px = pixels(spark, sf).withColumn("img", F.floor(F.col("img") / 4))
    return shown(px.groupBy("img", "y", "x").agg(F.max("v").alias("v")))


@query("tile_stitch", f"""WITH {_PX}, t AS (SELECT CAST(img // 2 AS BIGINT) AS img, y, CAST(x + (img % 2) * 5 AS INT) AS x, v FROM px)
    SELECT img, y, x, round(max(v), 6) + 0.0 AS v FROM t GROUP BY 1, 2, 3""")
def tile_stitch(spark, sf):
    """Two tiles that overlap in three columns, merged by maximum."""
    img = F.col("img")
    t = pixels(spark, sf).select(F.floor(img / 2).alias("img"), "y", (F.col("x") + img % 2 * 5).cast("int").alias("x"), "v")
    return shown(t.groupBy("img", "y", "x").agg(F.max("v").alias("v")))


@query("pad_edge", f"""WITH {_PX} SELECT p.img, CAST(r.i AS INT) AS y, CAST(c.i AS INT) AS x, round(p.v, 6) + 0.0 AS v
    FROM range(10) r(i), range(12) c(i) JOIN px p ON p.y = least(r.i, 7) AND p.x = least(c.i, 7)""")
def pad_edge(spark, sf):
    return shown(whole(spark, sf, lambda a: [scaling.padded(a, 0, 2, 0, 4, "edge")]))


@query("pad_reflect", f"""WITH {_PX} SELECT p.img, CAST(r.i AS INT) AS y, CAST(c.i AS INT) AS x, round(p.v, 6) + 0.0 AS v
    FROM range(12) r(i), range(12) c(i) JOIN px p ON p.y = {_mirror('r.i - 2', N)} AND p.x = {_mirror('c.i - 2', N)}""")
def pad_reflect(spark, sf):
    return shown(whole(spark, sf, lambda a: [scaling.padded(a, 2, 2, 2, 2, "reflect")]))


@query("pad_square", f"""WITH {_PX}, c AS (SELECT * FROM px WHERE y < 5)
    SELECT img, CAST(y.i AS INT) AS y, CAST(x.i AS INT) AS x, coalesce(round(v, 6), 0) + 0.0 AS v
    FROM (SELECT DISTINCT img FROM px) CROSS JOIN range(8) y(i) CROSS JOIN range(8) x(i)
    LEFT JOIN (SELECT img AS i2, y AS cy, x AS cx, v FROM c) ON i2 = img AND cy = y.i - 1 AND cx = x.i""")
def pad_square(spark, sf):
    """A mask of 5 x 8 in the middle of 8 x 8."""
    return shown(whole(spark, sf, lambda a: [scaling.padded(a[:5], *scaling.to_square(5, 8), "zero")]))


@query("roll_columns", f"WITH {_PX} SELECT img, y, (x + 4) % 8 AS x, round(v, 6) + 0.0 AS v, ((x + 4) % 8 + 8 - 4) % 8 AS back FROM px")
def roll_columns(spark, sf):
    rolled = F.pmod(F.col("x") + 4, F.lit(N))
    return pixels(spark, sf).select(
        "img", "y", rolled.alias("x"), (F.round("v", DIGITS) + 0.0).alias("v"), F.pmod(rolled - 4, F.lit(N)).alias("back"))


@query("seam_crop", f"WITH {_PX} SELECT img, y, ((x + 4) % 8) - 1 AS x, round(v, 6) + 0.0 AS v FROM px WHERE (x + 4) % 8 BETWEEN 1 AND 6")
def seam_crop(spark, sf):
    rolled = F.pmod(F.col("x") + 4, F.lit(N))
    return shown(pixels(spark, sf).withColumn("x", rolled).where("x BETWEEN 1 AND 6").withColumn("x", F.col("x") - 1))


@query("seam_alpha", """SELECT p_partkey AS id, CAST(x AS INT) AS x, round(least(least(greatest(x / r, 0), 1), least(greatest((n - 1 - x) / r, 0), 1)), 6) AS alpha
    FROM (SELECT p_partkey, p_size + 3 AS n, 1.0::DOUBLE + p_size % 5 AS r FROM part), range(64) t(x) WHERE x < n""")
def seam_alpha(spark, sf):
    """How a strip of p_size + 3 columns fades in from its ends, over 1 to 5 columns."""
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") + 3).alias("n"), (F.lit(1.0) + F.col("p_size") % 5).alias("r"))
    p = p.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    x, n, r = F.col("x"), F.col("n"), F.col("r")
    return p.select("id", "x", F.round(F.least(clip(x / r), clip((n - 1 - x) / r)), 6).alias("alpha"))


@query("pixelate", f"""WITH {_PX} SELECT img, y, x, round(avg(v) OVER (PARTITION BY img, y // 4, x // 4), 6) + 0.0 AS v FROM px""")
def pixelate(spark, sf):
    px = pixels(spark, sf).withColumn("by", F.floor(F.col("y") / 4)).withColumn("bx", F.floor(F.col("x") / 4))
    cells = px.groupBy("img", "by", "bx").agg(F.avg("v").alias("_m"))
    return shown(px.join(cells, ["img", "by", "bx"]).withColumn("v", F.col("_m")))


@query("bgr_rgb", f"WITH {_PX} SELECT img, y, x, CAST(2 - x % 3 AS INT) AS c, CAST(floor(round(v, 6) * 255) AS INT) AS u8 FROM px")
def bgr_rgb(spark, sf):
    """Every third column stands for a channel; channels turn around, floats become bytes by truncation."""
    return pixels(spark, sf).select("img", "y", "x", (2 - F.col("x") % 3).alias("c"), F.floor(F.round("v", 6) * 255).cast("int").alias("u8"))


@query("layout_roundtrip", f"WITH {_PX} SELECT img, y, x, round(v, 6) + 0.0 AS v, CAST(x * 8 + y AS INT) AS chw FROM px")
def layout_roundtrip(spark, sf):
    """HWC to CHW places and back."""
    px = pixels(spark, sf).withColumn("chw", (F.col("x") * N + F.col("y")).cast("int"))
    back = px.select("img", (F.col("chw") % N).alias("y"), F.floor(F.col("chw") / N).cast("int").alias("x"), "v", "chw")
    return back.select("img", "y", "x", (F.round("v", DIGITS) + 0.0).alias("v"), "chw")


@query("broadcast_batch", f"""SELECT e.vec_id AS img, CAST(i // {N} AS INT) AS y, CAST(i % {N} AS INT) AS x, round((e.embedding[i + 1]::DOUBLE + 1) / 2 - (o.embedding[i + 1]::DOUBLE + 1) / 2, 6) + 0.0 AS v
    FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) o, range({N * N}) t(i)""")
def broadcast_batch(spark, sf):
    """A batch of one against all: the single image (64 pixels) is broadcast."""
    px = pixels(spark, sf)
    one = px.where("img = 0").select("y", "x", F.col("v").alias("_o"))
    return shown(px.join(F.broadcast(one), ["y", "x"]).withColumn("v", F.col("v") - F.col("_o")))


_CC = f"""{_PX}, on_ AS (SELECT img, y, x, y * 8 + x AS p FROM px WHERE v >= 0.55),
    e AS (SELECT a.img, a.p AS a, b.p AS b FROM on_ a JOIN on_ b ON a.img = b.img AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
    r(img, p, q) AS (SELECT img, a, b FROM e UNION SELECT r.img, r.p, e.b FROM r JOIN e ON e.img = r.img AND e.a = r.q),
    l AS (SELECT img, CAST(p // 8 AS INT) AS y, CAST(p % 8 AS INT) AS x, CAST(min(q) AS BIGINT) AS label FROM r GROUP BY img, p)"""


def _labelled(spark, sf):
    lab = whole(spark, sf, lambda a: [K.label((a >= 0.55) * 1.0)]).where("v > 0")
    return lab.select("img", "y", "x", (F.col("v") - 1).cast("long").alias("label"))


@query("connected_components", f"WITH RECURSIVE {_CC} SELECT img, y, x, label FROM l")
def connected_components(spark, sf):
    return _labelled(spark, sf)


@query("component_stats", f"WITH RECURSIVE {_CC} SELECT img, label, min(y) AS y1, max(y) + 1 AS y2, min(x) AS x1, max(x) + 1 AS x2, count(*) AS area FROM l GROUP BY 1, 2")
def component_stats(spark, sf):
    return _labelled(spark, sf).groupBy("img", "label").agg(
        F.min("y").alias("y1"), (F.max("y") + 1).alias("y2"), F.min("x").alias("x1"), (F.max("x") + 1).alias("x2"), F.count("*").alias("area"))


@query("centroid", f"WITH RECURSIVE {_CC} SELECT img, label, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM l GROUP BY 1, 2")
def centroid(spark, sf):
    return _labelled(spark, sf).groupBy("img", "label").agg(F.round(F.avg("x"), 6).alias("cx"), F.round(F.avg("y"), 6).alias("cy"))


def _contours(batches):
    for b in K.pieces(batches):
        values = (b["e"].flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 1) / 2
        rows = [
            (img, name - 1, x, y)
            for img, a in zip(b["img"].to_pylist(), values.reshape(-1, N, N), strict=True) for name, x, y in K.contour_centroids(a >= 0.55)]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["img", "label", "cx", "cy"])


@query("contour_centroid", f"""WITH RECURSIVE {_CC}, m AS MATERIALIZED (SELECT img, label, y, x FROM l),
    b AS (SELECT img, label, min(y) - 1 AS y1, max(y) + 2 AS y2, min(x) - 1 AS x1, max(x) + 2 AS x2, arg_min(x, y * {N} + x) AS fx, min(y) AS fy FROM m GROUP BY 1, 2),
    g AS MATERIALIZED (SELECT b.img, b.label, CAST(y.y AS INT) AS y, CAST(x.x AS INT) AS x FROM b, range(-1, {N + 1}) y(y), range(-1, {N + 1}) x(x) WHERE y.y >= y1 AND y.y < y2 AND x.x >= x1 AND x.x < x2),
    free AS MATERIALIZED (SELECT * FROM g ANTI JOIN m USING (img, label, y, x)),
    out_ AS (SELECT img, label, CAST(y1 AS INT) AS y, CAST(x1 AS INT) AS x FROM b
      UNION SELECT f.img, f.label, f.y, f.x FROM out_ o JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(dy, dx) ON true
        JOIN free f ON f.img = o.img AND f.label = o.label AND f.y = o.y + dy AND f.x = o.x + dx),
    cells AS (SELECT img, label, y - dy AS cy, x - dx AS cx, count(*) AS n, avg(y) AS my, avg(x) AS mx
      FROM (SELECT * FROM g ANTI JOIN out_ USING (img, label, y, x)), range(2) a(dy), range(2) c(dx) GROUP BY 1, 2, 3, 4),
    s AS (SELECT img, label, sum(w) AS m00, sum(w * mx) / sum(w) AS cx, sum(w * my) / sum(w) AS cy
      FROM (SELECT *, CASE n WHEN 4 THEN 1.0::DOUBLE WHEN 3 THEN 0.5::DOUBLE END AS w FROM cells) WHERE w > 0 GROUP BY 1, 2)
    SELECT b.img, CAST(b.label AS BIGINT) AS label, round(coalesce(s.cx, fx), 6) + 0.0 AS cx, round(coalesce(s.cy, fy), 6) + 0.0 AS cy FROM b LEFT JOIN s USING (img, label)""")
def contour_centroid(spark, sf):
    """By the moments of the outer contour; without area, its first point."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("img"), F.col("embedding").cast("array<float>").alias("e"))
    out = e.mapInArrow(_contours, "img long, label long, cx double, cy double")
    return out.select("img", "label", (F.round("cx", 6) + 0.0).alias("cx"), (F.round("cy", 6) + 0.0).alias("cy"))


#: The view of the projection: horizontal and vertical field, yaw and pitch in degrees; target 12 x 24.
VIEW = {"fov": (90.0, 90.0), "yaw": 30.0, "pitch": -20.0}
TO_H, TO_W = 12, 24


def projection_grid(views, to_h=TO_H, to_w=TO_W, n=N):
    """(id, y, x, sx, sy): the places that views (id, fov_x, fov_y, yaw, pitch) have in their patch for each pixel of an equirectangular target that they see.

    Rotations are products of columns, so every view may have its own angles.
    """
    g = views.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(to_h - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(to_w - 1))))
    lon, lat = F.radians((F.col("x") / to_w - 0.5) * 360), F.radians((0.5 - F.col("y") / to_h) * 180)
    yaw, pitch = F.radians("yaw"), F.radians("pitch")
    g = g.withColumn("east", F.cos(lat) * F.sin(lon + yaw)).withColumn("north", F.cos(lat) * F.cos(lon + yaw)).withColumn("up", F.sin(lat))
    g = g.withColumn("ahead", F.col("north") * F.cos(pitch) + F.col("up") * F.sin(pitch)).withColumn("above", F.col("up") * F.cos(pitch) - F.col("north") * F.sin(pitch))
    u, v = (F.col(c) / F.col("ahead") / F.tan(F.radians(F.col(f) / 2)) for c, f in (("east", "fov_x"), ("above", "fov_y")))
    seen = g.where("ahead > 1e-9").withColumn("u", u).withColumn("v", v).where("abs(u) <= 1 AND abs(v) <= 1")
    return seen.select("id", "y", "x", ((F.col("u") + 1) / 2 * n).alias("sx"), ((1 - F.col("v")) / 2 * n).alias("sy"))


def _grid_sql(views: str) -> str:
    """g (id, y, x, sx, sy) of ``views`` (id, fx, fy, yaw, pitch), by rotation matrices."""
    return f"""g1 AS (SELECT v.*, CAST(a.i AS INT) AS y, CAST(b.i AS INT) AS x, (b.i / {TO_W}.0::DOUBLE - 0.5::DOUBLE) * 2 * pi() AS th, -(a.i / {TO_H}.0::DOUBLE - 0.5::DOUBLE) * pi() AS ph,
      radians(yaw) AS ru, radians(-pitch) AS rv FROM ({views}) v, range({TO_H}) a(i), range({TO_W}) b(i)),
    g2 AS (SELECT *, cos(ph) * sin(th) AS dx, sin(ph) AS dy, cos(ph) * cos(th) AS dz FROM g1),
    g3 AS (SELECT *, dx * cos(ru) + dz * sin(ru) AS px, -dx * sin(ru) * sin(rv) + dy * cos(rv) + dz * cos(ru) * sin(rv) AS py, -dx * sin(ru) * cos(rv) - dy * sin(rv) + dz * cos(ru) * cos(rv) AS pz FROM g2),
    g AS (SELECT id, y, x, (px / pz / tan(radians(fx / 2)) + 1) / 2 * {N} AS sx, (1 - py / pz / tan(radians(fy / 2))) / 2 * {N} AS sy FROM g3
      WHERE pz > 1e-9 AND abs(px / pz / tan(radians(fx / 2))) <= 1 AND abs(py / pz / tan(radians(fy / 2))) <= 1)"""


_VIEWS = "SELECT s_suppkey AS id, 71.3::DOUBLE + s_suppkey % 40 AS fx, 64.7::DOUBLE + s_suppkey % 30 AS fy, (s_suppkey * 37 % 360 - 180)::DOUBLE AS yaw, (s_suppkey * 13 % 120 - 60)::DOUBLE AS pitch FROM supplier"


@query("p2e_grid", f"WITH {_grid_sql(_VIEWS)} SELECT id, y, x, round(sx, 6) + 0.0 AS sx, round(sy, 6) + 0.0 AS sy FROM g")
def p2e_grid(spark, sf):
    """A view for each supplier, with its own fields and angles."""
    views = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "71.3D + s_suppkey % 40 AS fov_x", "64.7D + s_suppkey % 30 AS fov_y", "double(s_suppkey * 37 % 360 - 180) AS yaw", "double(s_suppkey * 13 % 120 - 60) AS pitch")
    return projection_grid(views).select("id", "y", "x", (F.round("sx", 6) + 0.0).alias("sx"), (F.round("sy", 6) + 0.0).alias("sy"))


_VIEW = f"SELECT 0 AS id, {VIEW['fov'][0]}::DOUBLE AS fx, {VIEW['fov'][1]}::DOUBLE AS fy, {VIEW['yaw']}::DOUBLE AS yaw, {VIEW['pitch']}::DOUBLE AS pitch"


@query("p2e_sample", f"""WITH {_PX}, {_grid_sql(_VIEW)}, c AS (SELECT y, x, CAST(floor(sx) AS INT) AS ix, CAST(floor(sy) AS INT) AS iy, sx - floor(sx) AS fx, sy - floor(sy) AS fy FROM g),
    k AS (SELECT y, x, ix + dx AS qx, iy + dy AS qy, (CASE dx WHEN 0 THEN 1 - fx ELSE fx END) * (CASE dy WHEN 0 THEN 1 - fy ELSE fy END) AS w FROM c, range(2) a(dx), range(2) b(dy))
    SELECT p.img, k.y, k.x, round(sum(k.w * p.v), 6) + 0.0 AS v FROM k JOIN px p ON p.x = k.qx AND p.y = k.qy GROUP BY 1, 2, 3""")
def p2e_sample(spark, sf):
    """The visible pixels of each image as a perspective patch, bilinear, zero outside of it: a kernel on whole rasters, no shuffle."""
    def sample(a):
        visible, y, x = sphere.patch_grid(TO_H, TO_W, N, N, VIEW["fov"], VIEW["yaw"], VIEW["pitch"])
        return [np.where(visible, sphere.taken(a, y, x), np.nan)]

    return shown(whole(spark, sf, sample).where(~F.isnan("v")))


_SOFT = K.soft_kernel(N, N, 0.4)


@query("soft_blur", f"WITH {_PX}, {_MK}, {_blur('mk', 'o', _SOFT, N)} {_out('o')}")
def soft_blur(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.convolve((a >= 0.5) * 1.0, _SOFT)]))


def _mirror_in(i: str, n: str) -> str:
    p = f"greatest(1, 2 * ({n} - 1))"
    m = f"((({i}) % {p} + {p}) % {p})"
    return f"(CASE WHEN {m} < {n} THEN {m} ELSE 2 * ({n} - 1) - {m} END)"


@query("roi_blur", f"""WITH RECURSIVE {_CC}, b AS (SELECT img, label, greatest(min(y) - 1, 0) AS y1, least(max(y) + 2, {N}) AS y2, greatest(min(x) - 1, 0) AS x1, least(max(x) + 2, {N}) AS x2
      FROM l GROUP BY 1, 2 HAVING count(*) >= 4),
    t AS MATERIALIZED (SELECT l.img, l.y, l.x, ky.w * kx.w AS w, CAST(y1 + {_mirror_in('l.y - y1 + ky.d', '(y2 - y1)')} AS INT) AS qy, CAST(x1 + {_mirror_in('l.x - x1 + kx.d', '(x2 - x1)')} AS INT) AS qx
      FROM l JOIN b USING (img, label), {_taps(_SIG).replace('k(d, w)', 'ky(d, w)')}, {_taps(_SIG).replace('k(d, w)', 'kx(d, w)')}),
    o AS (SELECT t.img, t.y, t.x, sum(t.w * q.v) AS v FROM t JOIN px q ON q.img = t.img AND q.y = t.qy AND q.x = t.qx GROUP BY 1, 2, 3)
    SELECT img, y, x, round(coalesce(o.v, px.v), {DIGITS}) + 0.0 AS v FROM px LEFT JOIN o USING (img, y, x)""")
def roi_blur(spark, sf):
    """Components of bright pixels, four pixels or more, blurred in place."""
    return shown(whole(spark, sf, lambda a: [K.roi_blur(a, a >= 0.55, _SIG, 1, 4)]))


_FACES = {"F": "u, v, 1.0", "R": "1.0, v, -u", "B": "-u, v, -1.0", "L": "-1.0, v, u", "U": "u, 1.0, -v", "D": "u, -1.0, v"}


def _cube_sql(n: int) -> str:
    """Bilinear taps (y, x, qy, qx, w) of six faces of side n below each other in an N x N panorama."""
    faces = " UNION ALL ".join(
        f"SELECT {k} AS face, i, j, {', '.join(f'CAST({c} AS DOUBLE) AS {d}' for c, d in zip(xyz.split(', '), ('dx', 'dy', 'dz'), strict=True))} FROM c" for k, xyz in enumerate(_FACES.values()))
    return f"""c AS (SELECT i, j, (j + 0.5::DOUBLE) / {n} * 2 - 1 AS u, -((i + 0.5::DOUBLE) / {n} * 2 - 1) AS v FROM range({n}) a(i), range({n}) b(j)), d AS ({faces}),
    s AS (SELECT CAST(face * {n} + i AS INT) AS y, CAST(j AS INT) AS x, (atan2(dx, dz) / (2 * pi()) + 0.5::DOUBLE) * {N} - 0.5::DOUBLE AS sx,
      least(greatest((0.5::DOUBLE - asin(least(1.0::DOUBLE, greatest(-1.0::DOUBLE, dy / sqrt(dx * dx + dy * dy + dz * dz)))) / pi()) * {N} - 0.5::DOUBLE, 0), {N - 1}) AS sy FROM d),
    k AS (SELECT y, x, CAST(least(floor(sy) + b, {N - 1}) AS INT) AS qy, CAST((floor(sx) + a + {N}) % {N} AS INT) AS qx,
      (CASE a WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) * (CASE b WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS w FROM s, range(2) p(a), range(2) q(b))"""


@query("equirect_to_cube", f"""WITH {_PX}, {_cube_sql(4)} SELECT px.img, k.y, k.x, round(sum(k.w * px.v), 6) + 0.0 AS v
    FROM k JOIN px ON px.y = k.qy AND px.x = k.qx GROUP BY 1, 2, 3""")
def equirect_to_cube(spark, sf):
    """Faces F, R, B, L, U, D below each other."""
    return shown(whole(spark, sf, lambda a: [K.equirect_to_cube(a, 4)]))


def _lanczos_sql(src: str, name: str, n: int, to: int) -> str:
    pi = "pi()"
    taps = f"""(SELECT d, CAST(least(greatest(i, 0), {n - 1}) AS INT) AS q, w / sum(w) OVER (PARTITION BY d) AS w FROM
      (SELECT d, i, CASE WHEN abs(s - i) >= 4 THEN 0 WHEN abs(s - i) < 1e-12 THEN 1 ELSE 4 * sin({pi} * (s - i)) * sin({pi} * (s - i) / 4) / ({pi} * {pi} * (s - i) * (s - i)) END AS w
       FROM (SELECT CAST(t.d AS INT) AS d, (t.d + 0.5::DOUBLE) * {n / to!r}::DOUBLE - 0.5::DOUBLE AS s, floor((t.d + 0.5::DOUBLE) * {n / to!r}::DOUBLE - 0.5::DOUBLE) + k.i AS i FROM range({to}) t(d), range(-3, 5) k(i))))"""
    return f"""{name}_x AS MATERIALIZED (SELECT p.img, p.y, k.d AS x, sum(p.v * k.w) AS v FROM {src} p JOIN {taps} k ON p.x = k.q GROUP BY 1, 2, 3),
    {name} AS (SELECT p.img, k.d AS y, p.x, sum(p.v * k.w) AS v FROM {name}_x p JOIN {taps} k ON p.y = k.q GROUP BY 1, 2, 3)"""


@query("resize_lanczos", f"WITH {_PX}, {_lanczos_sql('px', 'o', N, 12)} {_out('o')}")
def resize_lanczos(spark, sf):
    return shown(whole(spark, sf, lambda a: [K.lanczos(a, 12, 12)]))


@query("empty_image", "SELECT p_partkey AS img, CAST(c AS INT) AS c, CAST((p_size * 5127 >> (16 - 8 * c)) & 255 AS INT) AS u8, p_size * (p_size + 2) AS n FROM part, range(3) t(c)")
def empty_image(spark, sf):
    """Images of one colour (0xRRGGBB), size x (size + 2): a value and a number of pixels for each channel."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("img"), F.col("p_size").alias("s"), F.explode(F.array(*[F.lit(c) for c in range(3)])).alias("c"))
    return p.selectExpr("img", "c", "cast(shiftright(s * 5127, 16 - 8 * c) & 255 as int) AS u8", "s * (s + 2) AS n")


@query("decode_image", f"""WITH {_PX} SELECT img, {N} AS h, {N} AS w, true AS ok, CAST(sum(floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, v)) * 255)) AS BIGINT) AS total FROM px GROUP BY img""")
def decode_image(spark, sf):
    """Rasters written as PNG and read again; the sum of their bytes stands for them."""
    out = I.decoded(I.as_png(I.packed(pixels(spark, sf), N, N)))
    byte = lambda i: F.conv(F.hex(F.substring(F.col("data"), i, F.lit(1))), 16, 10).cast("bigint")
    total = F.aggregate(F.sequence(F.lit(1), F.length("data")), F.lit(0).cast("bigint"), lambda s, i: s + byte(i))
    return out.select("img", "h", "w", "ok", total.alias("total"))
