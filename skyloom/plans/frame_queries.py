"""Queries on colour frames of two sizes: six embeddings after each other are one frame, 8 x 16 or 4 x 32, in [0, 1].

The SQL works on pixels (img, par, y, x, c, v), par being the frame's size; resampling is written as
tables of taps (d: target place, q: source place, w: weight) for each axis.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import contours as C
from ..functions import kernels as K
from ..functions import nodes, scaling, sky, sphere
from ..operators import frames as FR
from ..operators import models as M
from ..operators import raster as R
from ..operators import stages as G
from ..operators import workflow_run as W
from ..sources import image_sink as S
from ..sources import work
from .base import query, table

#: Height and width by the frame's number, even and odd.
SIZES = ((8, 16), (4, 32))
PER_FRAME = 6
DIGITS = 6


def frames(spark, sf):
    """Whole frames only: the last embeddings, fewer than six, make none."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    rows = e.groupBy(F.floor(F.col("vec_id") / PER_FRAME).alias("img")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "e"))).alias("s")).where(F.size("s") == PER_FRAME)
    even = F.col("img") % 2 == 0
    side = lambda k: F.when(even, SIZES[0][k]).otherwise(SIZES[1][k]).cast("int")
    data = F.transform(F.flatten(F.transform("s", lambda r: r["e"])), lambda v: (v + 1) / 2)
    return rows.select(F.col("img").cast("long").alias("img"), side(0).alias("h"), side(1).alias("w"), F.lit(3).alias("c"), data.alias("data"))


def shown(df):
    px = FR.pixels(df)
    return px.select("img", "y", "x", "c", (F.round("v", DIGITS) + 0.0).alias("v"))


_FR = f"""px AS MATERIALIZED (SELECT img, par, CAST(p // (3 * w) AS INT) AS y, CAST((p // 3) % w AS INT) AS x, CAST(p % 3 AS INT) AS c, v FROM (
      SELECT vec_id // {PER_FRAME} AS img, CAST((vec_id // {PER_FRAME}) % 2 AS INT) AS par, (vec_id % {PER_FRAME}) * 64 + i AS p,
             CASE (vec_id // {PER_FRAME}) % 2 WHEN 0 THEN {SIZES[0][1]} ELSE {SIZES[1][1]} END AS w, (embedding[i + 1]::DOUBLE + 1) / 2 AS v
      FROM (SELECT *, count(*) OVER (PARTITION BY vec_id // {PER_FRAME}) AS k FROM embeddings), range(64) t(i) WHERE k = {PER_FRAME})),
    dims(par, h, w) AS (VALUES {", ".join(f"({k}, {h}, {w})" for k, (h, w) in enumerate(SIZES))})"""
_D = "::DOUBLE"


def _out(rel, v="v"):
    return f"SELECT img, y, x, c, round({v}, {DIGITS}) + 0.0 AS v FROM {rel}"


def _mirror(i, n):
    p = f"greatest(1, 2 * ({n} - 1))"
    return f"(CASE WHEN (({i}) % {p} + {p}) % {p} < {n} THEN (({i}) % {p} + {p}) % {p} ELSE 2 * ({n} - 1) - (({i}) % {p} + {p}) % {p} END)"


def _along(src, name, ky, kx, extra="c"):
    """``src`` (img, par, y, x, extra, v) resampled by taps tables ky and kx (par, d, q, w)."""
    return f"""{name}_x AS MATERIALIZED (SELECT s.img, s.par, s.y, k.d AS x, {extra}, sum(s.v * k.w) AS v FROM {src} s JOIN {kx} k ON k.par = s.par AND k.q = s.x GROUP BY ALL),
    {name} AS MATERIALIZED (SELECT s.img, s.par, k.d AS y, s.x, {extra}, sum(s.v * k.w) AS v FROM {name}_x s JOIN {ky} k ON k.par = s.par AND k.q = s.y GROUP BY ALL)"""


def _conv_taps(name, kernel, sides):
    """Taps of a mirrored convolution; ``sides``: (par, n) rows."""
    taps = ", ".join(f"({d}, {w!r}{_D})" for d, w in kernel)
    return f"{name} AS (SELECT par, CAST(d AS INT) AS d, CAST({_mirror('d + o', 'n')} AS INT) AS q, sum(w) AS w FROM ({sides}) s(par, n), range(64) t(d), (VALUES {taps}) k(o, w) WHERE d < n GROUP BY ALL)"


def _halve_taps(name, sides):
    return f"{name} AS (SELECT par, CAST(d AS INT) AS d, CAST(2 * d + o AS INT) AS q, 0.5{_D} AS w FROM ({sides}) s(par, n), range(64) t(d), range(2) k(o) WHERE d < n // 2)"


def _scale_taps(name, how, sides):
    """Taps from n to t places; ``sides``: (par, n, t) rows."""
    base = f"(SELECT par, n, t, CAST(d AS INT) AS d, n{_D} / t AS r FROM ({sides}) s(par, n, t), range(64) g(d) WHERE d < t)"
    if how == "area":
        cover = "greatest(0, least((d + 1) * r, q + 1) - greatest(d * r, q)) / r"
        return f"{name} AS (SELECT par, d, CAST(q AS INT) AS q, {cover} AS w FROM {base}, range(64) h(q) WHERE q < n AND {cover} > 0)"
    reach = {"bilinear": 1, "bicubic": 2, "lanczos": 4}[how]
    a = scaling.CUBIC
    weight = {
        "bilinear": "greatest(0, 1 - e)",
        "bicubic": f"CASE WHEN e <= 1 THEN {a + 2} * e * e * e - {a + 3} * e * e + 1 WHEN e < 2 THEN {a} * e * e * e - {5 * a} * e * e + {8 * a} * e - {4 * a} ELSE 0 END",
        "lanczos": "CASE WHEN e >= 4 THEN 0 WHEN e < 1e-12 THEN 1 ELSE 4 * sin(pi() * e) * sin(pi() * e / 4) / (pi() * pi() * e * e) END"}[how]
    return f"""{name} AS (SELECT par, d, CAST(least(greatest(i, 0), n - 1) AS INT) AS q, sum(w / total) AS w FROM (
      SELECT *, sum(w) OVER (PARTITION BY par, d) AS total FROM (SELECT *, {weight} AS w FROM (
        SELECT *, abs((d + 0.5{_D}) * r - 0.5{_D} - i) AS e FROM (SELECT *, floor((d + 0.5{_D}) * r - 0.5{_D}) + o AS i FROM {base}, range({1 - reach}, {reach + 1}) h(o)))))
      GROUP BY ALL)"""


_H, _W = "SELECT par, h FROM dims", "SELECT par, w FROM dims"


# Spheres ------------------------------------------------------------------------------------------------------

FACE = 4


def _faced(src, name):
    """``src`` with dx, dy, dz; adds face, u, v: where the longest axis meets the cube."""
    return f"""{name}_f AS (SELECT *, CASE WHEN abs(dz) >= greatest(abs(dx), abs(dy)) - 1e-9 THEN CASE WHEN dz > 0 THEN 0 ELSE 2 END
      WHEN abs(dx) >= abs(dy) - 1e-9 THEN CASE WHEN dx > 0 THEN 1 ELSE 3 END WHEN dy > 0 THEN 4 ELSE 5 END AS face FROM {src}),
    {name} AS (SELECT *, CASE face WHEN 0 THEN dx / dz WHEN 1 THEN -dz / dx WHEN 2 THEN dx / dz WHEN 3 THEN -dz / dx ELSE dx / abs(dy) END AS u,
      CASE face WHEN 4 THEN -dz / dy WHEN 5 THEN -dz / dy WHEN 0 THEN dy / dz WHEN 1 THEN dy / dx WHEN 2 THEN -dy / dz ELSE -dy / dx END AS v FROM {name}_f)"""


def _around(src, name, keys):
    """Taps (par, keys, qy, qx, w) of directions dx, dy, dz in panoramas of ``dims``: bilinear, columns wrap, rows clamp."""
    return f"""{name}_s AS (SELECT par, {keys}, h, w AS ww, (atan2(dx, dz) / (2 * pi()) + 0.5{_D}) * w - 0.5{_D} AS sx,
      least(greatest((0.5{_D} - asin(least(1.0{_D}, greatest(-1.0{_D}, dy / sqrt(dx * dx + dy * dy + dz * dz)))) / pi()) * h - 0.5{_D}, 0), h - 1) AS sy FROM {src}, dims),
    {name} AS MATERIALIZED (SELECT par, {keys}, CAST(least(floor(sy) + b, h - 1) AS INT) AS qy, CAST((floor(sx) + a + ww) % ww AS INT) AS qx,
      sum((CASE a WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) * (CASE b WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END)) AS w
      FROM {name}_s, range(2) p(a), range(2) q(b) GROUP BY ALL)"""


_PLANE = {
    "dx": "CASE face WHEN 0 THEN u WHEN 1 THEN 1 WHEN 2 THEN -u WHEN 3 THEN -1 ELSE u END", "dy": "CASE face WHEN 4 THEN 1 WHEN 5 THEN -1 ELSE v END",
    "dz": "CASE face WHEN 0 THEN 1 WHEN 1 THEN -u WHEN 2 THEN -1 WHEN 3 THEN u WHEN 4 THEN -v ELSE v END"}
_DIRECTION = ", ".join(f"CAST({e} AS DOUBLE) AS {d}" for d, e in _PLANE.items())
#: Faces (img, par, face, i, j, c, v) of all frames.
_CUBE = f"""cd AS (SELECT face, i, j, {_DIRECTION} FROM (SELECT CAST(f AS INT) AS face, CAST(i AS INT) AS i, CAST(j AS INT) AS j, (j + 0.5{_D}) / {FACE} * 2 - 1 AS u,
      1 - (i + 0.5{_D}) / {FACE} * 2 AS v FROM range(6) a(f), range({FACE}) b(i), range({FACE}) d(j))),
    {_around("cd", "ck", "face, i, j")},
    cube AS MATERIALIZED (SELECT p.img, p.par, k.face, k.i, k.j, p.c, sum(k.w * p.v) AS v FROM ck k JOIN px p ON p.par = k.par AND p.y = k.qy AND p.x = k.qx GROUP BY ALL)"""
#: Taps (par, y, x, face, i, j, w) from faces to panoramas; beyond a face the nearest pixel of its neighbour.
_UNFOLD = f"""ed AS (SELECT par, CAST(y AS INT) AS y, CAST(x AS INT) AS x, cos(lat) * sin(lon) AS dx, sin(lat) AS dy, cos(lat) * cos(lon) AS dz FROM (
      SELECT *, ((x + 0.5{_D}) / w - 0.5{_D}) * 2 * pi() AS lon, (0.5{_D} - (y + 0.5{_D}) / h) * pi() AS lat FROM dims, range(64) a(y), range(64) b(x) WHERE y < h AND x < w)),
    {_faced("ed", "ef")},
    et AS (SELECT par, y, x, f0, CAST(floor(sx) + a AS INT) AS tx, CAST(floor(sy) + b AS INT) AS ty,
      (CASE a WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) * (CASE b WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS wt
      FROM (SELECT par, y, x, face AS f0, (u + 1) / 2 * {FACE} - 0.5{_D} AS sx, (1 - v) / 2 * {FACE} - 0.5{_D} AS sy FROM ef), range(2) p(a), range(2) q(b)),
    eo AS (SELECT par, y, x, f0, tx, ty, wt, {_DIRECTION} FROM (SELECT *, f0 AS face, (tx + 0.5{_D}) / {FACE} * 2 - 1 AS u, 1 - (ty + 0.5{_D}) / {FACE} * 2 AS v FROM et)),
    {_faced("eo", "eg")},
    unfold AS MATERIALIZED (SELECT par, y, x, CASE WHEN beyond THEN face ELSE f0 END AS face,
      CAST(CASE WHEN beyond THEN least(greatest(floor((1 - v) / 2 * {FACE} + 1e-9), 0), {FACE - 1}) ELSE ty END AS INT) AS i,
      CAST(CASE WHEN beyond THEN least(greatest(floor((u + 1) / 2 * {FACE} + 1e-9), 0), {FACE - 1}) ELSE tx END AS INT) AS j, sum(wt) AS w
      FROM (SELECT *, tx < 0 OR tx >= {FACE} OR ty < 0 OR ty >= {FACE} AS beyond FROM eg) GROUP BY ALL)"""


@query("cube_to_equirect", f"""WITH {_FR}, {_CUBE}, {_UNFOLD},
    o AS (SELECT f.img, k.y, k.x, f.c, sum(k.w * f.v) AS v FROM unfold k JOIN cube f USING (par, face, i, j) GROUP BY ALL) {_out("o")}""")
def cube_to_equirect(spark, sf):
    """Panoramas taken apart into cube faces and put together again."""
    return shown(FR.mapped(frames(spark, sf), lambda a: sphere.panorama_of(sphere.faces_of(a, FACE), *a.shape[:2])))


@query("cube_mask", f"""WITH {_FR}, {_CUBE}, {_UNFOLD},
    g AS (SELECT img, par, face, i, j, avg(v) AS v FROM cube WHERE face < 5 GROUP BY ALL),
    s AS (SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, CAST({_mirror("i + di", FACE)} AS INT) AS qi, CAST({_mirror("j + dj", FACE)} AS INT) AS qj
      FROM range({FACE}) a(i), range({FACE}) b(j), range(-1, 2) d(di), range(-1, 2) e(dj)),
    m AS MATERIALIZED (SELECT g.img, g.par, g.face, s.i, s.j, CASE WHEN max(g.v) >= 0.55 THEN 1.0{_D} ELSE 0 END AS v FROM g JOIN s ON g.i = s.qi AND g.j = s.qj GROUP BY ALL),
    o AS (SELECT m.img, k.y, k.x, sum(k.w * m.v) AS v FROM unfold k JOIN m USING (par, face, i, j) GROUP BY ALL)
    SELECT p.img, p.y, p.x, CAST(floor(round(coalesce(o.v, 0), 6) * 255) AS INT) AS u8 FROM px p LEFT JOIN o USING (img, y, x) WHERE p.c = 0""")
def cube_mask(spark, sf):
    """Masks of five faces by a stand-in model that looks at neighbouring pixels, mirrored at the edges; the face below stays empty."""
    slot = M.Slot("spread", M.spread_brightness, (("reach", 1),))
    out = M.cube_masks(frames(spark, sf), slot, FACE, pad=1, threshold=0.55)
    return shown(out.where("error is null").drop("error")).select("img", "y", "x", F.floor(F.col("v") * 255).cast("int").alias("u8"))


PATCH = {"fov": (100.0, 80.0), "yaw": 30.0, "pitch": -20.0, "feather": 1}
TOP = {"fov": (70.0, 70.0), "yaw": 180.0, "pitch": 50.0, "feather": 1}
#: Side of the view that is repaired, and the radius of its hole as a share of half the side.
VIEW, HOLE = 6, 0.8


def _num(v):
    return f"({v!r}{_D})"


def _grid_sql(name, patch_h, patch_w, fov, yaw, pitch):
    """(par, y, x, sy, sx): places of the visible pixels of panoramas in a patch."""
    u, v = math.radians(yaw), math.radians(-pitch)
    cu, su, cv, sv = (_num(f) for f in (math.cos(u), math.sin(u), math.cos(v), math.sin(v)))
    tx, ty = (_num(math.tan(math.radians(f) / 2)) for f in fov)
    return f"""{name}_d AS (SELECT par, h, w, y, x, cos(lat) * sin(lon) AS dx, sin(lat) AS dy, cos(lat) * cos(lon) AS dz FROM (
      SELECT *, (x{_D} / w - 0.5{_D}) * 2 * pi() AS lon, -(y{_D} / h - 0.5{_D}) * pi() AS lat FROM dims, range(64) a(y), range(64) b(x) WHERE y < h AND x < w)),
    {name}_c AS (SELECT par, h, w, y, x, dx * {cu} + dz * {su} AS cx, (dz * {cu} - dx * {su}) * {sv} + dy * {cv} AS cy, (dz * {cu} - dx * {su}) * {cv} - dy * {sv} AS cz FROM {name}_d),
    {name} AS MATERIALIZED (SELECT par, CAST(y AS INT) AS y, CAST(x AS INT) AS x, (1 - cy / cz / {ty}) / 2 * {patch_h} AS sy, (cx / cz / {tx} + 1) / 2 * {patch_w} AS sx FROM {name}_c
      WHERE cz > 1e-9 AND abs(cx / cz / {tx}) <= 1 AND abs(cy / cz / {ty}) <= 1)"""


def _alpha_sql(grid, name, feather):
    """(par, y, x, v): the visible part, eroded and blurred."""
    vis = f"""{name}_v AS (SELECT 0 AS img, par, y, x, 0 AS c, CASE WHEN g.sx IS NULL THEN 0.0{_D} ELSE 1.0{_D} END AS v
      FROM (SELECT par, CAST(y AS INT) AS y, CAST(x AS INT) AS x FROM dims, range(64) a(y), range(64) b(x) WHERE y < h AND x < w) LEFT JOIN {grid} g USING (par, y, x)),
    {name}_1 AS (SELECT * REPLACE (min(v) OVER (PARTITION BY par, y ORDER BY x ROWS BETWEEN {feather} PRECEDING AND {feather} FOLLOWING) AS v) FROM {name}_v),
    {name}_2 AS (SELECT * REPLACE (min(v) OVER (PARTITION BY par, x ORDER BY y ROWS BETWEEN {feather} PRECEDING AND {feather} FOLLOWING) AS v) FROM {name}_1)"""
    kernel = R.kernel_of_feather(feather)
    return f"{vis}, {_conv_taps(name + '_ky', kernel, _H)}, {_conv_taps(name + '_kx', kernel, _W)}, {_along(name + '_2', name, name + '_ky', name + '_kx')}"


def _laid(grid, patch, name):
    """Patches (img, par, y, x, c, v) sampled at the grid; nothing outside of them."""
    return f"""{name}_t AS (SELECT par, y, x, CAST(floor(sy) + b AS INT) AS qy, CAST(floor(sx) + a AS INT) AS qx,
      (CASE a WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) * (CASE b WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS w FROM {grid}, range(2) p(a), range(2) q(b)),
    {name} AS MATERIALIZED (SELECT p.img, k.y, k.x, p.c, sum(k.w * p.v) AS v FROM {name}_t k JOIN {patch} p ON p.par = k.par AND p.y = k.qy AND p.x = k.qx GROUP BY ALL)"""


_GRIDS = ", ".join(_grid_sql(f"g{k}", h, w, PATCH["fov"], PATCH["yaw"], PATCH["pitch"]) for k, (h, w) in enumerate(SIZES))
_PATCHED = f"""{_FR}, {_GRIDS}, g AS (SELECT * FROM g0 WHERE par = 0 UNION ALL SELECT * FROM g1 WHERE par = 1), {_alpha_sql("g", "al", PATCH["feather"])},
    fl AS (SELECT img, par, CAST(h - 1 - y AS INT) AS y, x, c, v FROM px JOIN dims USING (par)), {_laid("g", "fl", "la")}"""
_PATCHED_SQL = f"""WITH {_PATCHED} SELECT p.img, p.y, p.x, p.c, round(p.v * (1 - a.v) + coalesce(l.v, 0) * a.v, {DIGITS}) + 0.0 AS merged, round(coalesce(l.v, 0), {DIGITS}) + 0.0 AS patch,
    round(a.v, {DIGITS}) + 0.0 AS alpha FROM px p JOIN al a ON a.par = p.par AND a.y = p.y AND a.x = p.x LEFT JOIN la l ON l.img = p.img AND l.y = p.y AND l.x = p.x AND l.c = p.c"""


def _flipped(df):
    return FR.mapped(df, lambda a: a[::-1])


def _patch_pixels(rows):
    """(img, y, x, c, merged, patch, alpha) of rows with the three as arrays (h, w, 3), (h, w, 3) and (h, w)."""
    i = F.col("i")
    at = rows.select("img", "w", "patch_360", "mask", F.posexplode("merged").alias("i", "m"))
    pixel = F.floor(i / 3)
    shown_ = lambda v, name: (F.round(v, DIGITS) + 0.0).alias(name)
    return at.select(
        "img", F.floor(pixel / F.col("w")).cast("int").alias("y"), (pixel % F.col("w")).cast("int").alias("x"), (i % 3).alias("c"), shown_(F.col("m"), "merged"),
        shown_(F.get("patch_360", i), "patch"), shown_(F.get("mask", pixel.cast("int")), "alpha"))


@query("perspective_patch", _PATCHED_SQL)
def perspective_patch(spark, sf):
    """The frame upside down, as a perspective patch, laid into the frame; the patch in the panorama, and its soft edge."""
    base = frames(spark, sf)

    def run(batches):
        for b in FR.pieces(batches):
            made = [[] for _ in range(3)]
            for a, p in zip(FR.arrays(b, "_0"), FR.arrays(b, "_1"), strict=True):
                for out, part in zip(made, sphere.patched(a, p, PATCH["fov"], PATCH["yaw"], PATCH["pitch"], PATCH["feather"]), strict=True):
                    out.append(part.ravel())
            yield pa.record_batch([b["img"], b["w_0"], *[pa.array(m, pa.list_(pa.float64())) for m in made]], names=["img", "w", "merged", "patch_360", "mask"])

    side = lambda df, k: df.select("img", *[F.col(c).alias(f"{c}_{k}") for c in FR.COLUMNS[1:]])
    rows = side(base, 0).join(side(_flipped(base), 1), "img").mapInArrow(run, "img long, w int, merged array<double>, patch_360 array<double>, mask array<double>")
    return _patch_pixels(rows)


@query("node_projection", _PATCHED_SQL)
def node_projection(spark, sf):
    """The same as a node that SQL calls: its parameters are checked and its columns named at analysis."""
    nodes.register(spark)
    base = frames(spark, sf)
    both = base.join(_flipped(base).select("img", *[F.col(c).alias(f"p_{c}") for c in FR.COLUMNS[1:]]), "img")
    call = f"fov_w => {PATCH['fov'][0]}, fov_h => {PATCH['fov'][1]}, u_deg => {PATCH['yaw']}, v_deg => {PATCH['pitch']}, feather => {PATCH['feather']}"
    rows = spark.sql(f"SELECT * FROM perspective_to_equirectangular(TABLE({{both}}), {call})", both=both)
    return _patch_pixels(rows)


def _hole():
    c = (np.arange(VIEW) + 0.5) / VIEW * 2 - 1
    return c[None, :] ** 2 + c[:, None] ** 2 <= HOLE * HOLE


def _view_sql(name, fov, yaw, pitch):
    u, v = math.radians(yaw), math.radians(pitch)
    cu, su, cv, sv = (_num(f) for f in (math.cos(u), math.sin(u), math.cos(v), math.sin(v)))
    tx, ty = (_num(math.tan(math.radians(f) / 2)) for f in fov)
    return f"""{name}_d AS (SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, vx * {cu} + (-vy * {sv} + {cv}) * {su} AS dx, vy * {cv} + {sv} AS dy, -vx * {su} + (-vy * {sv} + {cv}) * {cu} AS dz FROM (
      SELECT i, j, (2 * j{_D} / {VIEW - 1} - 1) * {tx} AS vx, (1 - 2 * i{_D} / {VIEW - 1}) * {ty} AS vy FROM range({VIEW}) a(i), range({VIEW}) b(j))), {_around(name + "_d", name, "i, j")}"""


def _top_sql(src, name):
    """CTEs that end with ``name``: ``src`` with the view to the top repaired."""
    return f"""{_view_sql("vk", TOP["fov"], TOP["yaw"], TOP["pitch"])},
    vw AS MATERIALIZED (SELECT p.img, p.par, k.i AS y, k.j AS x, p.c, sum(k.w * p.v) AS v,
      power((k.j + 0.5{_D}) / {VIEW} * 2 - 1, 2) + power((k.i + 0.5{_D}) / {VIEW} * 2 - 1, 2) <= {HOLE * HOLE!r}{_D} AS hole FROM vk k JOIN {src} p ON p.par = k.par AND p.y = k.qy AND p.x = k.qx GROUP BY ALL),
    fx AS (SELECT img, par, y, x, c, CASE WHEN hole THEN avg(v) FILTER (NOT hole) OVER (PARTITION BY img, c) ELSE v END AS v FROM vw),
    {_grid_sql("g", VIEW, VIEW, TOP["fov"], -TOP["yaw"], TOP["pitch"])}, {_alpha_sql("g", "al", TOP["feather"])}, {_laid("g", "fx", "la")},
    {name} AS MATERIALIZED (SELECT p.img, p.par, p.y, p.x, p.c, p.v * (1 - a.v) + coalesce(l.v, 0) * a.v AS v FROM {src} p JOIN al a ON a.par = p.par AND a.y = p.y AND a.x = p.x
      LEFT JOIN la l ON l.img = p.img AND l.y = p.y AND l.x = p.x AND l.c = p.c)"""


@query("top_fix", f"WITH {_FR}, {_top_sql('px', 'o')} {_out('o')}")
def top_fix(spark, sf):
    """The view to the top behind, its disc filled by the mean around it (in place of an inpainting model), laid back with a soft edge."""
    return shown(FR.mapped(frames(spark, sf), lambda a: sphere.repaired_view(a, K.fill_mean, _hole(), TOP["fov"], TOP["yaw"], TOP["pitch"], TOP["feather"])))


# Sizes --------------------------------------------------------------------------------------------------------

BOUND_H, BOUND_W, MULTIPLE = 7, 11, 3
_TO = f"""tz AS (SELECT par, h, w, greatest({MULTIPLE}, th - th % {MULTIPLE}) AS th, greatest({MULTIPLE}, tw - tw % {MULTIPLE}) AS tw FROM (
      SELECT par, h, w, CAST(greatest(1, round_even(h * r, 0)) AS INT) AS th, CAST(greatest(1, round_even(w * r, 0)) AS INT) AS tw FROM (SELECT *, least({BOUND_H}{_D} / h, {BOUND_W}{_D} / w) AS r FROM dims)))"""


def _resize_sql(how):
    return f"""WITH {_FR}, {_TO}, {_scale_taps("ky", how, "SELECT par, h, th FROM tz")}, {_scale_taps("kx", how, "SELECT par, w, tw FROM tz")}, {_along("px", "o", "ky", "kx")} {_out("o")}"""


def _resized(spark, sf, how):
    def kernel(a):
        return scaling.resized(a, *scaling.target_size(*a.shape[:2], BOUND_H, BOUND_W, "keep", "always", MULTIPLE), how)

    return shown(FR.mapped(frames(spark, sf), kernel))


@query("image_to_mask", f"WITH {_FR} SELECT img, y, x, round(v, {DIGITS}) + 0.0 AS v FROM px WHERE c = 1")
def image_to_mask(spark, sf):
    """The green channel of each frame, as the node of a workflow gives it."""
    return shown(FR.mapped(frames(spark, sf), lambda a: W.KERNELS["ImageToMask"](image=a, channel="green"))).drop("c")


@query("mask_to_image", f"WITH {_FR}, m AS (SELECT img, y, x, avg(v) AS v FROM px GROUP BY ALL) SELECT img, y, x, CAST(c AS INT) AS c, round(1 - v, {DIGITS}) + 0.0 AS v FROM m, range(3) t(c)")
def mask_to_image(spark, sf):
    """The reverse of each frame's mean of channels, as a mask in three channels."""
    return shown(FR.mapped(frames(spark, sf), lambda a: W.KERNELS["MaskToImage"](mask=W.KERNELS["InvertMask"](mask=a.mean(axis=2)))))


@query("resize_area", _resize_sql("area"))
def resize_area(spark, sf):
    """In their shapes within 7 x 11, down to multiples of 3: 3 x 9 of both sizes, by the overlap of pixels."""
    return _resized(spark, sf, "area")


@query("resize_bicubic", _resize_sql("bicubic"))
def resize_bicubic(spark, sf):
    return _resized(spark, sf, "bicubic")


@query("pad_multiple", f"""WITH {_FR}, t AS (SELECT par, h, w, h + (6 - h % 6) % 6 AS th, w + (6 - w % 6) % 6 AS tw FROM dims)
    SELECT p.img, CAST(y.i AS INT) AS y, CAST(x.i AS INT) AS x, p.c, round(p.v, {DIGITS}) + 0.0 AS v, CAST(t.h AS INT) AS h, CAST(t.w AS INT) AS w, true AS same
    FROM t JOIN range(64) y(i) ON y.i < th JOIN range(64) x(i) ON x.i < tw JOIN px p ON p.par = t.par AND p.y = least(y.i, t.h - 1) AND p.x = least(x.i, t.w - 1)""")
def pad_multiple(spark, sf):
    """Edges repeated up to multiples of 6, and taken off again (same: the frame comes back)."""
    return _padded_query(spark, sf, lambda a: (scaling.to_multiple(*a.shape[:2], 6), "edge"))


@query("pad_mirror", f"""WITH {_FR}
    SELECT p.img, CAST(y.i AS INT) AS y, CAST(x.i AS INT) AS x, p.c, round(p.v, {DIGITS}) + 0.0 AS v, CAST(t.h AS INT) AS h, CAST(t.w AS INT) AS w, true AS same
    FROM dims t JOIN range(64) y(i) ON y.i < h + 4 JOIN range(64) x(i) ON x.i < w + 4
    JOIN px p ON p.par = t.par AND p.y = {_mirror("y.i - 2", "t.h")} AND p.x = {_mirror("x.i - 2", "t.w")}""")
def pad_mirror(spark, sf):
    return _padded_query(spark, sf, lambda a: ((2, 2, 2, 2), "reflect"))


@query("pad_to_square", f"""WITH {_FR}, t AS (SELECT *, greatest(h, w) AS s FROM dims)
    SELECT i.img, CAST(y.i AS INT) AS y, CAST(x.i AS INT) AS x, CAST(c.i AS INT) AS c, round(coalesce(p.v, 0), {DIGITS}) + 0.0 AS v, CAST(t.h AS INT) AS h, CAST(t.w AS INT) AS w, true AS same
    FROM t JOIN (SELECT DISTINCT img, par FROM px) i USING (par) JOIN range(64) y(i) ON y.i < s JOIN range(64) x(i) ON x.i < s JOIN range(3) c(i) ON true
    LEFT JOIN px p ON p.img = i.img AND p.y = y.i - (s - h) // 2 AND p.x = x.i - (s - w) // 2 AND p.c = c.i""")
def pad_to_square(spark, sf):
    return _padded_query(spark, sf, lambda a: (scaling.to_square(*a.shape[:2]), "zero"))


def _padded_query(spark, sf, plan):
    """Pixels of the padded frames, the sizes of the frames, and if unpadding gives them back."""
    df = frames(spark, sf)
    back = FR.together(lambda a, p: np.array([[[float((scaling.unpadded(p, *plan(a)[0]) == a).all())]]]), df, FR.mapped(df, lambda a: scaling.padded(a, *plan(a)[0], plan(a)[1])))
    wide = shown(FR.mapped(df, lambda a: scaling.padded(a, *plan(a)[0], plan(a)[1])))
    sides = df.select("img", "h", "w").join(back.select("img", (F.get("data", F.lit(0)) == 1).alias("same")), "img")
    return wide.join(sides, "img")


# Photographs --------------------------------------------------------------------------------------------------

SEAM = {"seam": 2, "pad": 3, "ramp": 2, "sigma": 0.6}


def _seam_sql(src, name):
    """CTEs that end with ``name``: ``src`` with its seam repaired."""
    kernel = ", ".join(f"({d}, {w!r}{_D})" for d, w in R.kernel_of_sigma(SEAM["sigma"]))
    return f"""st AS (SELECT par, CAST(x AS INT) AS x, ((x + w // 2) % w) - w // 2 AS d FROM dims, range(64) t(x) WHERE x < w),
    lim AS (SELECT par, greatest(-{SEAM["seam"] + SEAM["pad"]}, -(w // 2)) AS lo, least({SEAM["seam"] + SEAM["pad"]}, w - w // 2) - 1 AS hi FROM dims),
    sw AS (SELECT par, x, d, lo, hi, d - lo AS k, hi - lo + 1 AS n, CASE WHEN d >= -{SEAM["seam"]} AND d < {SEAM["seam"]} THEN 1.0{_D} ELSE 0 END AS hard FROM st JOIN lim USING (par) WHERE d BETWEEN lo AND hi),
    sb AS (SELECT a.par, a.x, least(1.0{_D}, least(a.k, a.n - 1 - a.k) / {SEAM["ramp"]}{_D}) AS fade, sum(t.w * b.hard) AS weight FROM sw a, (VALUES {kernel}) t(o, w), sw b
      WHERE b.par = a.par AND b.k = {_mirror("a.k + t.o", "a.n")} GROUP BY ALL),
    sa AS (SELECT img, c, avg(v) AS m FROM {src} JOIN sb USING (par, x) WHERE weight = 0 GROUP BY ALL),
    {name} AS MATERIALIZED (SELECT p.img, p.par, p.y, p.x, p.c, p.v + coalesce(fade * weight * (m - p.v), 0) AS v FROM {src} p LEFT JOIN sb USING (par, x) LEFT JOIN sa ON sa.img = p.img AND sa.c = p.c)"""


@query("seam_repair", f"WITH {_FR}, {_seam_sql('px', 'o')} {_out('o')}")
def seam_repair(spark, sf):
    """Where the ends meet, filled by the mean of the strip around (in place of an inpainting model), with a blurred mask and soft ends."""
    return shown(FR.mapped(frames(spark, sf), lambda a: K.repaired_seam(a, K.fill_mean, **SEAM)))


def partners(df):
    """Frames 2k and 2k + 1 change places: each has a partner of the other size; a last one without is left out."""
    return df.withColumn("img", F.col("img") + F.when(F.col("img") % 2 == 0, 1).otherwise(-1))


_SKY_DILATION, _SKY_RADIUS, _SKY_LEVELS = 1, 1, 2
_R2 = R.kernel_of_radius(2)


def _sky_sql(name):
    """CTEs, pixels first, that end with ``name``: frames with their partner's sky."""
    lanczos = lambda name, frm, to: _scale_taps(name, "lanczos", f"SELECT par, {frm}, {to} FROM ms")
    parts = [
        _FR,
        "pt AS MATERIALIZED (SELECT CASE WHEN img % 2 = 0 THEN img + 1 ELSE img - 1 END AS img, 1 - par AS par, y, x, c, v FROM px)",
        # the partner's size, and the middle of it that has the frame's shape
        """ms AS (SELECT d.par, d.h, d.w, o.h AS oh, o.w AS ow, CASE WHEN o.w * d.h > d.w * o.h THEN o.h ELSE CAST(round_even(o.w * d.h / d.w::DOUBLE, 0) AS INT) END AS ch,
          CASE WHEN o.w * d.h > d.w * o.h THEN CAST(round_even(o.h * d.w / d.h::DOUBLE, 0) AS INT) ELSE o.w END AS cw FROM dims d JOIN dims o ON o.par = 1 - d.par)""",
        "mc AS (SELECT img, par, CAST(y - (oh - ch) // 2 AS INT) AS y, CAST(x - (ow - cw) // 2 AS INT) AS x, 0 AS c, v, ch, cw FROM pt JOIN ms USING (par) WHERE c = 0)",
        "mi AS (SELECT img, par, y, x, c, v FROM mc WHERE y >= 0 AND y < ch AND x >= 0 AND x < cw)",
        lanczos("mky", "ch", "h"), lanczos("mkx", "cw", "w"), _along("mi", "ma", "mky", "mkx"),
        "mb AS (SELECT * REPLACE (greatest(0, least(1, v)) AS v) FROM ma)",
        "mo AS (SELECT img, avg(v) FILTER (y < greatest(1, h // 3)) AS top, avg(v) FILTER (y >= 2 * h // 3) AS low FROM mb JOIN dims USING (par) GROUP BY img)",
        f"mh AS MATERIALIZED (SELECT img, par, y, x, c, CASE WHEN CASE WHEN top < low THEN 1 - v ELSE v END >= {127 / 255!r} - 1e-9 THEN 1.0{_D} ELSE 0 END AS v FROM mb JOIN mo USING (img))",
        f"md1 AS (SELECT * REPLACE (max(v) OVER (PARTITION BY img, y ORDER BY x ROWS BETWEEN {_SKY_DILATION} PRECEDING AND {_SKY_DILATION} FOLLOWING) AS v) FROM mh)",
        f"md AS (SELECT * REPLACE (max(v) OVER (PARTITION BY img, x ORDER BY y ROWS BETWEEN {_SKY_DILATION} PRECEDING AND {_SKY_DILATION} FOLLOWING) AS v) FROM md1)",
        _conv_taps("sy", R.kernel_of_radius(_SKY_RADIUS), _H), _conv_taps("sx", R.kernel_of_radius(_SKY_RADIUS), _W), _along("md", "mf", "sy", "sx"),
        "m0 AS MATERIALIZED (SELECT * REPLACE (greatest(0, least(1, v)) AS v) FROM mf)",
        lanczos("lky", "oh", "h"), lanczos("lkx", "ow", "w"), _along("pt", "b0", "lky", "lkx"), "a0 AS (SELECT * FROM px)",
    ]
    for k in range(_SKY_LEVELS):
        h, w = (f"SELECT par, {s} // {2**k} FROM dims" for s in "hw")
        parts += [_conv_taps(f"vy{k}", _R2, h), _conv_taps(f"vx{k}", _R2, w), _halve_taps(f"hy{k}", h), _halve_taps(f"hx{k}", w)]
        up = lambda s: f"SELECT par, {s} // {2 ** (k + 1)}, {s} // {2**k} FROM dims"  # noqa: E731, B023
        parts += [_scale_taps(f"uy{k}", "bilinear", up("h")), _scale_taps(f"ux{k}", "bilinear", up("w"))]
        for r in "abm":
            parts += [_along(f"{r}{k}", f"{r}{k}v", f"vy{k}", f"vx{k}"), _along(f"{r}{k}v", f"{r}{k + 1}", f"hy{k}", f"hx{k}")]
            if r != "m":
                parts += [_along(f"{r}{k + 1}", f"{r}{k}u", f"uy{k}", f"ux{k}"), f"{r}{k}l AS (SELECT s.img, s.par, s.y, s.x, s.c, s.v - u.v AS v FROM {r}{k} s JOIN {r}{k}u u USING (img, y, x, c))"]
    mix = lambda a, b, m, o: f"{o} AS MATERIALIZED (SELECT a.img, a.par, a.y, a.x, a.c, a.v * (1 - m.v) + b.v * m.v AS v FROM {a} a JOIN {b} b USING (img, y, x, c) JOIN {m} m ON m.img = a.img AND m.y = a.y AND m.x = a.x)"
    top = _SKY_LEVELS
    parts.append(mix(f"a{top}", f"b{top}", f"m{top}", f"r{top}"))
    for k in range(top - 1, -1, -1):
        parts += [mix(f"a{k}l", f"b{k}l", f"m{k}", f"n{k}"), _along(f"r{k + 1}", f"r{k}u", f"uy{k}", f"ux{k}"),
                  f"r{k} AS MATERIALIZED (SELECT n.img, n.par, n.y, n.x, n.c, n.v + u.v AS v FROM n{k} n JOIN r{k}u u USING (img, y, x, c))"]
    parts.append("hit AS (SELECT img, max(v) AS any_ FROM mh GROUP BY img)")
    parts.append(f"""{name} AS MATERIALIZED (SELECT p.img, p.par, p.y, p.x, p.c, CASE WHEN any_ > 0 THEN greatest(0, least(1, r.v)) ELSE p.v END AS v
        FROM px p JOIN r0 r USING (img, y, x, c) JOIN hit ON hit.img = p.img)""")
    return ", ".join(parts)


@query("sky_replace", f"WITH {_sky_sql('o')} {_out('o')}")
def sky_replace(spark, sf):
    """The partner's frame as new sky, its first channel as the mask, both of another size and shape."""
    df = frames(spark, sf)
    other = partners(df)

    def kernel(a, b):
        return sky.replaced(a, b, b[..., 0], _SKY_DILATION, _SKY_RADIUS, _SKY_LEVELS)

    return shown(FR.together(kernel, df, other))


_SIG = R.kernel_of_sigma(0.9)
SOFT = {"pad": 1, "min_area": 3, "threshold": 0.55}


def _soft_sql(mask, pad, min_area, threshold, sigma):
    """SQL after the CTEs of the pixels; ``mask`` is the body of sm (img, par, y, x, s).  Boxes come one after the other, as each mixes into what the one before left."""
    taps = ", ".join(f"({d}, {w!r}{_D})" for d, w in R.kernel_of_sigma(sigma))
    return f"""sm AS MATERIALIZED ({mask}), {_labels_sql("sm", f"s >= {threshold}")},
    b AS MATERIALIZED (SELECT img, row_number() OVER (PARTITION BY img ORDER BY label) AS k, greatest(min(y) - {pad}, 0) AS y1, least(max(y) + 1 + {pad}, h) AS y2, greatest(min(x) - {pad}, 0) AS x1, least(max(x) + 1 + {pad}, w) AS x2
      FROM l JOIN dims USING (par) GROUP BY img, label, h, w HAVING count(*) >= {min_area}),
    cell AS MATERIALIZED (SELECT b.img, b.k, p.y, p.x, p.c, y1, y2, x1, x2 FROM b JOIN px p ON p.img = b.img AND p.y >= y1 AND p.y < y2 AND p.x >= x1 AND p.x < x2),
    bx AS MATERIALIZED (SELECT e.img, e.k, e.y, e.x, e.c, e.y1, e.y2, sum(t.w * q.v) AS v FROM cell e, (VALUES {taps}) t(o, w), px q
      WHERE q.img = e.img AND q.c = e.c AND q.y = e.y AND q.x = e.x1 + {_mirror("e.x - e.x1 + t.o", "(e.x2 - e.x1)")} GROUP BY ALL),
    bl AS MATERIALIZED (SELECT e.img, e.k, e.y, e.x, e.c, sum(t.w * q.v) AS v FROM bx e, (VALUES {taps}) t(o, w), bx q
      WHERE q.img = e.img AND q.k = e.k AND q.c = e.c AND q.x = e.x AND q.y = e.y1 + {_mirror("e.y - e.y1 + t.o", "(e.y2 - e.y1)")} GROUP BY ALL),
    o AS (SELECT p.img, p.y, p.x, p.c, p.v, s.s, list(bl.v ORDER BY bl.k) FILTER (bl.v IS NOT NULL) AS vs FROM px p JOIN sm s USING (img, y, x) LEFT JOIN bl ON bl.img = p.img AND bl.y = p.y AND bl.x = p.x AND bl.c = p.c GROUP BY ALL)
    SELECT img, y, x, c, round(CASE WHEN vs IS NULL THEN v ELSE list_reduce(list_prepend(v, vs), lambda a, n: a * (1 - s) + n * s) END, {DIGITS}) + 0.0 AS v FROM o"""


def _labels_sql(src, on):
    """l (img, par, y, x, label): 8-connected components of the pixels of ``src`` where ``on``; a label is its least flat place."""
    return f"""on_ AS MATERIALIZED (SELECT img, par, y, x, y * w + x AS p, w FROM {src} JOIN dims USING (par) WHERE {on}),
    ce AS MATERIALIZED (SELECT a.img, a.p AS a, b.p AS b FROM on_ a JOIN on_ b ON a.img = b.img AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
    cr(img, p, q) AS (SELECT img, a, b FROM ce UNION SELECT cr.img, cr.p, ce.b FROM cr JOIN ce ON ce.img = cr.img AND ce.a = cr.q),
    l AS MATERIALIZED (SELECT o.img, o.par, o.y, o.x, CAST(m.label AS BIGINT) AS label FROM on_ o JOIN (SELECT img, p, min(q) AS label FROM cr GROUP BY ALL) m USING (img, p))"""


@query("soft_region_blur", f"WITH RECURSIVE {_FR}, {_soft_sql('SELECT img, par, y, x, avg(v) AS s FROM px GROUP BY ALL', sigma=0.9, **SOFT)}")
def soft_region_blur(spark, sf):
    """Around components of bright pixels, mixed by brightness in their padded boxes."""
    return shown(FR.mapped(frames(spark, sf), lambda a: K.soft_region_blur(a, a.mean(axis=2), _SIG, **SOFT)))


FINISH = G.Finish(TOP["fov"], TOP["yaw"], TOP["pitch"], TOP["feather"], SEAM["seam"], SEAM["pad"], SEAM["ramp"], SEAM["sigma"], _SKY_DILATION, _SKY_RADIUS, _SKY_LEVELS)


@query("finish_stage", f"""WITH {_sky_sql("sr")}, jb AS MATERIALIZED (SELECT p.img, p.par, p.y, p.x, p.c, CASE WHEN p.img % 3 = 0 THEN p.v ELSE sr.v END AS v FROM px p LEFT JOIN sr USING (img, y, x, c)
      WHERE p.img % 3 = 0 OR sr.v IS NOT NULL), {_top_sql("jb", "tf")}, {_seam_sql("tf", "o")} {_out("o")}""")
def finish_stage(spark, sf):
    """Edited images finished: sky replaced by the partner's, but for every third image, then the view to the top and the seam repaired.

    Images without a partner (the last one may have none) have no job, unless they are a third image.
    """
    df = frames(spark, sf)
    ids = df.select("img")
    partner = ids.select(F.col("img").alias("p"))
    other = F.col("img") + F.when(F.col("img") % 2 == 0, 1).otherwise(-1)
    third = F.col("img") % 3 == 0
    jobs = ids.join(partner, other == F.col("p"), "left").where(third | F.col("p").isNotNull())
    named = F.when(~third, F.col("p"))
    out = G.finished(jobs.select("img", named.alias("sky"), named.alias("mask")), df, _hole(), K.fill_mean, FINISH)
    return shown(out.where("error is null"))


#: Stand-ins for the detectors: limit, side, what the box is moved by; least confidences; the blur.
FIND_F = (("limit", 0.53), ("above", True), ("off", (0.5, -0.25, 0.5, 0.0)))
FIND_LP = (("limit", 0.47), ("above", False), ("off", (0.7, 0.0, -0.6, -0.2)))
LEAST_CONF = {"F": 0.54, "LP": 0.45}
BLUR = G.Blur(mask_threshold=0.45, mask_feather=0.6, sigma=0.9, scope="roi", pad=1, min_area=2, roi_threshold=0.3, least_contour=1.0)


def _found(spark, sf):
    slots = {"F": M.Slot("bright", M.box_finder, FIND_F), "LP": M.Slot("dark", M.box_finder, FIND_LP)}
    return G.detections(G.cube_rows(frames(spark, sf), FACE), slots, FACE, LEAST_CONF)


def _boxes_sql(name):
    clip = lambda f: ", ".join(
        f"CAST(greatest(0, least({f(c)}, {FACE - (1 if c[1] == '1' else 0)})) AS INT) AS {c}" for c in ("x1", "y1", "x2", "y2"))
    even, cut = (lambda c: f"round_even({c}, 0)"), (lambda c: f"trunc({c})")
    box = lambda off: f"min(j) + {off[0]} AS x1, min(i) + {off[1]} AS y1, max(j) + 1 + {off[2]} AS x2, max(i) + 1 + {off[3]} AS y2, avg(v) AS conf"
    f, lp = dict(FIND_F), dict(FIND_LP)
    return f"""fg AS MATERIALIZED (SELECT img, par, face, i, j, avg(v) AS v FROM cube WHERE face < 4 GROUP BY ALL),
    fb AS (SELECT img, par, face, {box(f["off"])} FROM fg WHERE v >= {f["limit"]} GROUP BY ALL), lb AS (SELECT img, par, face, {box(lp["off"])} FROM fg WHERE v <= {lp["limit"]} GROUP BY ALL),
    {name} AS MATERIALIZED (SELECT * FROM (SELECT img, par, face, 'F' AS typ, {clip(even)}, conf FROM fb WHERE conf >= {LEAST_CONF["F"]} UNION ALL
      SELECT img, par, face, 'LP', {clip(cut)}, conf FROM lb WHERE conf >= {LEAST_CONF["LP"]}) WHERE x2 > x1 AND y2 > y1)"""


@query("detect_regions", f"""WITH {_FR}, {_CUBE}, {_boxes_sql("bx")} SELECT img AS image, ['F', 'R', 'B', 'L'][face + 1] AS face, typ, x1, y1, x2, y2, round(conf, {DIGITS}) AS conf FROM bx""")
def detect_regions(spark, sf):
    """Boxes that two stand-in detectors find on the side faces: rounded or cut by their kind, clipped, above their least confidence."""
    return _found(spark, sf).where("error is null").select("image", "face", "typ", "x1", "y1", "x2", "y2", F.round("conf", DIGITS).alias("conf"))


_REGION_MASK = f"""SELECT p.img, p.par, p.y, p.x, coalesce(m.v, 0) AS s FROM (SELECT DISTINCT img, par, y, x FROM px) p LEFT JOIN rf m USING (img, y, x)"""


@query("blur_stage", f"""WITH RECURSIVE {_FR}, {_CUBE}, {_UNFOLD}, {_boxes_sql("dt")},
    dn AS (SELECT *, row_number() OVER (ORDER BY img, face, typ, x1, y1) AS det FROM dt),
    un AS (SELECT d.img, d.par, d.det, k.y, k.x, sum(k.w) AS v FROM dn d JOIN unfold k ON k.par = d.par AND k.face = d.face AND k.i >= d.y1 AND k.i < d.y2 AND k.j >= d.x1 AND k.j < d.x2 GROUP BY ALL),
    rh AS MATERIALIZED (SELECT i.img, i.par, i.y, i.x, 0 AS c, CASE WHEN coalesce(max(un.v), 0) >= {BLUR.mask_threshold} THEN 1.0{_D} ELSE 0 END AS v
      FROM (SELECT DISTINCT img, par, y, x FROM px WHERE img IN (SELECT img FROM dn)) i LEFT JOIN un USING (img, y, x) GROUP BY ALL),
    {_conv_taps("ry", R.kernel_of_sigma(BLUR.mask_feather), _H)}, {_conv_taps("rx", R.kernel_of_sigma(BLUR.mask_feather), _W)}, {_along("rh", "rf0", "ry", "rx")},
    rf AS (SELECT * REPLACE (greatest(0, least(1, v)) AS v) FROM rf0),
    {_soft_sql(_REGION_MASK, BLUR.pad, BLUR.min_area, BLUR.roi_threshold, BLUR.sigma)}""")
def blur_stage(spark, sf):
    """From panoramas to blurred panoramas: cube faces, detectors, boxes, masks in the panorama, soft blur around their components."""
    out = G.blurred(frames(spark, sf), _found(spark, sf), FACE, BLUR)
    return shown(out.where("error is null").select(*FR.COLUMNS))


def _two_boxes(df):
    """A face in the left and a plate in the right half of each frame, of sizes that follow its number."""
    i, h = F.col("img"), F.col("h")
    box = lambda typ, x1, y1, x2, y2: F.struct(F.lit(typ).alias("typ"), *[c.cast("int").alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])
    both = F.array(box("F", i % 3, i % 2, 5 + i % 4, h - i % 3), box("LP", 9 + i % 4, F.lit(0), 14 + i % 3, 2 + i % 3))
    return df.select(i.alias("image"), F.explode(both).alias("b")).select("image", "b.*", F.lit(0.5).alias("conf"))


_TWO_BOXES = """bx AS (SELECT img, par, typ, CAST(x1 AS INT) AS x1, CAST(y1 AS INT) AS y1, CAST(x2 AS INT) AS x2, CAST(y2 AS INT) AS y2, CAST(x2 - x1 AS INT) AS w, CAST(y2 - y1 AS INT) AS h FROM (
      SELECT img, par, 'F' AS typ, img % 3 AS x1, img % 2 AS y1, 5 + img % 4 AS x2, h - img % 3 AS y2 FROM (SELECT DISTINCT img, par FROM px) JOIN dims USING (par)
      UNION ALL SELECT img, par, 'LP', 9 + img % 4, 0, 14 + img % 3, 2 + img % 3 FROM (SELECT DISTINCT img, par FROM px))),
    bp AS MATERIALIZED (SELECT b.img, b.typ, b.h, b.w, CAST(p.y - y1 AS INT) AS y, CAST(p.x - x1 AS INT) AS x, p.c, p.v, y1, x1 FROM bx b JOIN px p ON p.img = b.img AND p.y >= y1 AND p.y < y2 AND p.x >= x1 AND p.x < x2)"""
_BOXED_OUT = f"SELECT p.img, p.y, p.x, p.c, round(coalesce(o.v, p.v), {DIGITS}) + 0.0 AS v FROM px p LEFT JOIN o ON o.img = p.img AND o.y = p.y AND o.x = p.x AND o.c = p.c"


@query("anonymize_soft", f"""WITH {_FR}, {_TWO_BOXES}, kw AS (SELECT DISTINCT h, w, greatest(3, CAST(floor(least(h, w) * 0.8{_D}) AS INT)) AS k FROM bp),
    kr AS (SELECT h, w, (CASE k % 2 WHEN 0 THEN k + 1 ELSE k END) // 2 AS r FROM kw), kt AS (SELECT h, w, o, exp(-(o * o) / (2 * power(0.3{_D} * (r - 1) + 0.8{_D}, 2))) AS e FROM kr, range(-20, 21) t(o) WHERE abs(o) <= r),
    kn AS MATERIALIZED (SELECT h, w, CAST(o AS INT) AS o, e / sum(e) OVER (PARTITION BY h, w) AS e FROM kt),
    ox AS MATERIALIZED (SELECT a.img, a.typ, a.h, a.w, a.y, a.x, a.c, a.y1, a.x1, sum(k.e * q.v) AS v FROM bp a JOIN kn k ON k.h = a.h AND k.w = a.w JOIN bp q ON q.img = a.img AND q.typ = a.typ AND q.c = a.c AND q.y = a.y AND q.x = {_mirror("a.x + k.o", "a.w")} GROUP BY ALL),
    o AS (SELECT a.img, a.y + a.y1 AS y, a.x + a.x1 AS x, a.c, sum(k.e * q.v) AS v FROM ox a JOIN kn k ON k.h = a.h AND k.w = a.w JOIN ox q ON q.img = a.img AND q.typ = a.typ AND q.c = a.c AND q.x = a.x AND q.y = {_mirror("a.y + k.o", "a.h")} GROUP BY ALL)
    {_BOXED_OUT}""")
def anonymize_soft(spark, sf):
    """Two boxes of each frame blurred by a share of their sizes."""
    df = frames(spark, sf)
    return shown(G.anonymized(df, _two_boxes(df), "soft", strength=0.8))


@query("anonymize_pixelate", f"""WITH {_FR}, {_TWO_BOXES}, d AS (SELECT *, greatest(1, h // 2) AS sh, greatest(1, w // 2) AS sw FROM bp),
    sm AS MATERIALIZED (SELECT img, typ, c, j, i, sum(v * greatest(0, least((j + 1) * h{_D} / sh, y + 1) - greatest(j * h{_D} / sh, y)) * greatest(0, least((i + 1) * w{_D} / sw, x + 1) - greatest(i * w{_D} / sw, x))) * sh * sw / (h * w) AS v
      FROM d, range(16) a(j), range(16) b(i) WHERE j < sh AND i < sw GROUP BY img, typ, c, j, i, h, w, sh, sw),
    o AS (SELECT d.img, d.y + y1 AS y, d.x + x1 AS x, d.c, CASE WHEN d.h > 1 AND d.w > 1 THEN s.v ELSE d.v END AS v FROM d JOIN sm s ON s.img = d.img AND s.typ = d.typ AND s.c = d.c AND s.j = d.y * sh // d.h AND s.i = d.x * sw // d.w)
    {_BOXED_OUT}""")
def anonymize_pixelate(spark, sf):
    """Two boxes of each frame in cells of about two pixels."""
    df = frames(spark, sf)
    return shown(G.anonymized(df, _two_boxes(df), "pixelate", factor=2))


TILES = G.Tiles(height=0, width=0, rows=1, cols=3, ratio=0.1, more_x=1, more_y=0, pad=1, dilation=1)


@query("tiled_masks", f"""WITH {_FR}, sm AS MATERIALIZED (SELECT img, par, y, x, avg(v) AS s FROM px GROUP BY ALL),
    gw AS (SELECT par, h, w, w + (3 - w % 3) % 3 AS pw FROM dims), ts AS (SELECT *, pw // 3 AS size, least(pw // 3 // 2, CAST(floor(pw // 3 * 0.1{_D}) AS INT) + 1) AS over FROM gw),
    tw AS (SELECT par, h, w, k, least(pw, k * size - CASE WHEN k > 0 THEN over ELSE 0 END + size + over) AS x2, size + over AS len FROM ts, range(3) t(k)),
    tp AS MATERIALIZED (SELECT s.img, t.par, t.k, t.h, t.w, s.y, x2 - len + i AS x, s.s FROM tw t JOIN range(64) o(i) ON i < len JOIN sm s ON s.par = t.par AND s.x = least(x2 - len + i, t.w - 1)),
    tm AS (SELECT a.img, a.par, a.h, a.w, a.k, a.y, a.x, greatest(max(b.s), max(CASE WHEN b.s >= 0.6 THEN 1.0{_D} ELSE 0 END)) AS v FROM tp a JOIN tp b ON b.img = a.img AND b.k = a.k AND abs(b.y - a.y) <= 1 AND abs(b.x - a.x) <= 1 GROUP BY ALL),
    o AS (SELECT img, h, w, y, x, max(v) AS v FROM tm WHERE x < w GROUP BY ALL)
    SELECT i.img, CAST(a.y AS INT) AS y, CAST(b.x AS INT) AS x, CAST(floor(round(coalesce(o.v, 0), 6) * 255) AS INT) AS u8 FROM (SELECT DISTINCT img, h, w FROM o) i, range(64) a(y), range(64) b(x)
    LEFT JOIN o ON o.img = i.img AND o.y = a.y - (greatest(i.h, i.w) - i.h) // 2 AND o.x = b.x - (greatest(i.h, i.w) - i.w) // 2 WHERE a.y < greatest(i.h, i.w) AND b.x < greatest(i.h, i.w)""")
def tiled_masks(spark, sf):
    """Masks of whole panoramas from two stand-in models over three overlapping tiles each, in the middle of a square."""
    whole = M.Slot("spread", M.spread_brightness, (("reach", 1),))
    spots = M.Slot("brightness", M.brightness_mask, (("sensitivity", 0.6), ("least_rows", 1)))
    out = G.tiled_masks(frames(spark, sf), whole, spots, TILES)
    return shown(out.where("error is null").select(*FR.COLUMNS)).select("img", "y", "x", F.floor(F.col("v") * 255).cast("int").alias("u8"))


@query("view_perspective", f"""WITH {_FR}, {_view_sql("vk", (90.0, 60.0), 40.0, -15.0)}
    SELECT p.img, k.i AS y, k.j AS x, p.c, round(sum(k.w * p.v), {DIGITS}) + 0.0 AS v FROM vk k JOIN px p ON p.par = k.par AND p.y = k.qy AND p.x = k.qx GROUP BY ALL""")
def view_perspective(spark, sf):
    """A perspective view of each panorama, to the right and down."""
    return shown(FR.mapped(frames(spark, sf), lambda a: sphere.view_of(a, (90.0, 60.0), 40.0, -15.0, VIEW, VIEW)))


# Contours -----------------------------------------------------------------------------------------------------

ON = 0.53
_STEPS = ", ".join(f"({k}, {dy}, {dx})" for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))))
_TRACED = f"""{_FR}, sm AS MATERIALIZED (SELECT img, par, y, x, avg(v) AS s FROM px GROUP BY ALL), {_labels_sql("sm", f"s >= {ON}")},
    free AS MATERIALIZED (SELECT i.img, i.par, CAST(y AS INT) AS y, CAST(x AS INT) AS x FROM (SELECT DISTINCT img, par FROM px) i JOIN dims USING (par), range(-1, 64) a(y), range(-1, 64) b(x)
      WHERE y <= h AND x <= w AND NOT EXISTS (SELECT 1 FROM l WHERE l.img = i.img AND l.y = a.y AND l.x = b.x)),
    out_ AS (SELECT DISTINCT img, -1 AS y, -1 AS x FROM px UNION SELECT f.img, f.y, f.x FROM out_ o JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(dy, dx) ON true
      JOIN free f ON f.img = o.img AND f.y = o.y + dy AND f.x = o.x + dx),
    outer_ AS MATERIALIZED (SELECT DISTINCT l.img, l.label FROM l JOIN out_ o ON o.img = l.img AND abs(o.y - l.y) + abs(o.x - l.x) = 1),
    own AS MATERIALIZED (SELECT l.* FROM l JOIN outer_ USING (img, label)), way(way, dy, dx) AS (VALUES {_STEPS}),
    first_ AS MATERIALIZED (SELECT img, label, CAST(label // w AS INT) AS y0, CAST(label % w AS INT) AS x0 FROM own JOIN dims USING (par) GROUP BY ALL),
    tr(img, label, k, py, px, y, x, came, way, way0) AS (
      SELECT img, label, 0, -1, -1, y0, x0, 4, -1, -1 FROM first_
      UNION ALL
      SELECT n.img, n.label, n.k + 1, n.y, n.x, n.y + w.dy, n.x + w.dx, (w.way + 4) % 8, w.way, CASE WHEN n.k = 0 THEN w.way ELSE n.way0 END
      FROM (SELECT t.img, t.label, t.k, t.y, t.x, t.came, t.way0, min((w.way - t.came + 7) % 8) AS turn FROM tr t JOIN way w ON true
        JOIN own m ON m.img = t.img AND m.label = t.label AND m.y = t.y + w.dy AND m.x = t.x + w.dx GROUP BY ALL) n
      JOIN way w ON w.way = (n.came + n.turn + 1) % 8 JOIN first_ f ON f.img = n.img AND f.label = n.label
      WHERE NOT (n.k > 0 AND n.y = f.y0 AND n.x = f.x0 AND w.way = n.way0)),
    pts AS MATERIALIZED (SELECT img, label, CAST(k - 1 AS INT) AS k, py AS y, px AS x, way FROM tr WHERE k > 0
      UNION ALL SELECT img, label, 0, y0, x0, -1 FROM first_ WHERE (img, label) NOT IN (SELECT img, label FROM tr WHERE k > 0)),
    seg AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY img, label) AS n, coalesce(lead(y) OVER p, first_value(y) OVER p) AS ny, coalesce(lead(x) OVER p, first_value(x) OVER p) AS nx,
      coalesce(lag(way) OVER p, last_value(way) OVER (PARTITION BY img, label ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS before FROM pts WINDOW p AS (PARTITION BY img, label ORDER BY k))"""


@query("trace_contours", f"WITH RECURSIVE {_TRACED} SELECT img, label, k, y, x, n < 3 OR way <> before AS corner FROM seg")
def trace_contours(spark, sf):
    """The outer contours' points in order, and at which of them they turn."""
    def run(batches):
        for b in FR.pieces(batches):
            rows = []
            for img, a in zip(b["img"].to_pylist(), FR.arrays(b), strict=True):
                for name, points in C.outer_contours(a.mean(axis=2) >= ON):
                    turns = set(C.corner_places(points))
                    rows += [(img, name - 1, k, y, x, k in turns) for k, (y, x) in enumerate(points)]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["img", "label", "k", "y", "x", "corner"])

    return frames(spark, sf).mapInArrow(run, "img long, label long, k int, y int, x int, corner boolean")


COLOUR, LEAST = (24 / 255, 180 / 255, 24 / 255), 1.0
#: The letter of a face in the annotation, with a margin, as it is drawn.
_LETTER = ("       ", " ##### ", " #     ", " #     ", " ####  ", " #     ", " #     ", " #     ", "       ")


@query("annotate_contours", f"""WITH RECURSIVE {_TRACED},
    ar AS (SELECT img, label, abs(sum(x * ny - nx * y)) / 2.0{_D} AS area, sum(x * ny - nx * y) AS twice, sum((y + ny) * (x * ny - nx * y)) AS my, sum((x + nx) * (x * ny - nx * y)) AS mx FROM seg GROUP BY ALL),
    big AS MATERIALIZED (SELECT * FROM ar WHERE area >= {LEAST}),
    line AS (SELECT DISTINCT p.img, p.y, p.x FROM seg JOIN big USING (img, label) JOIN sm p ON p.img = seg.img AND p.y BETWEEN least(seg.y, ny) - 1 AND greatest(seg.y, ny) + 1 AND p.x BETWEEN least(seg.x, nx) - 1 AND greatest(seg.x, nx) + 1,
      LATERAL (SELECT greatest(0, least(1, ((p.y - seg.y) * (ny - seg.y) + (p.x - seg.x) * (nx - seg.x)) / greatest(1, (ny - seg.y) * (ny - seg.y) + (nx - seg.x) * (nx - seg.x)){_D})) AS t) z
      WHERE power(p.y - seg.y - t * (ny - seg.y), 2) + power(p.x - seg.x - t * (nx - seg.x), 2) <= 1 + 1e-9),
    main AS (SELECT b.img, CAST(greatest(0, least(floor(my / (3.0{_D} * twice) + 1e-6), h - 9)) AS INT) AS ty, CAST(greatest(0, least(floor(mx / (3.0{_D} * twice) + 1e-6), w - 7)) AS INT) AS tx
      FROM (SELECT *, row_number() OVER (PARTITION BY img ORDER BY area DESC, label) AS r FROM big) b JOIN (SELECT DISTINCT img, par FROM px) USING (img) JOIN dims USING (par) WHERE r = 1),
    ink AS (SELECT m.img, CAST(ty + i AS INT) AS y, CAST(tx + j AS INT) AS x, substr(g.line, CAST(j + 1 AS INT), 1) = '#' AS white FROM main m, (VALUES {", ".join(f"({i}, '{t}')" for i, t in enumerate(_LETTER))}) g(i, line), range(7) t(j))
    SELECT p.img, p.y, p.x, p.c, round(CASE WHEN white THEN 1 WHEN white IS NOT NULL OR line.img IS NOT NULL THEN CASE p.c WHEN 1 THEN {COLOUR[1]!r}{_D} ELSE {COLOUR[0]!r}{_D} END ELSE p.v END, {DIGITS}) + 0.0 AS v
    FROM px p LEFT JOIN line USING (img, y, x) LEFT JOIN ink USING (img, y, x)""")
def annotate_contours(spark, sf):
    """Contours drawn two pixels wide, with the letter of their kind at the largest one."""
    return shown(FR.mapped(frames(spark, sf), lambda a: C.annotated(a, a.mean(axis=2) >= ON, "F", COLOUR, LEAST)))


# Files, models, workflows -------------------------------------------------------------------------------------

def _path(ending):
    return F.concat(F.lit("part"), F.col("img") % 5, F.lit("/frame_"), "img", F.lit(ending))


@query("sink_jpeg", f"WITH {_FR} SELECT img, 'part' || img % 5 || '/frame_' || img || '.jpg' AS path, CAST(max(y) + 1 AS INT) AS h, CAST(max(x) + 1 AS INT) AS w, true AS close FROM px GROUP BY img")
def sink_jpeg(spark, sf):
    """JPEG files of quality 95, read by Spark's image reader; close: brightness differs by less than 0.02 in the mean."""
    df = frames(spark, sf)
    folder = work.shared_path(spark)
    S.write_images(FR.as_bytes(df, _path(".jpg")), folder, quality=95)
    back = S.read_images(spark, folder)
    img = F.regexp_extract("path", "frame_([0-9]+)", 1).cast("long")
    weights = np.array([0.299, 0.587, 0.114])
    error = FR.together(lambda a, b: np.abs((a - b) @ weights).mean().reshape(1, 1, 1), df, FR.from_bytes(back, img))
    return back.select(img.alias("img"), "path", F.col("height").alias("h"), F.col("width").alias("w")).join(
        error.select("img", (F.get("data", F.lit(0)) < 0.02).alias("close")), "img")


@query("sink_png_colour", f"WITH {_FR} SELECT img, y, x, c, CAST(floor(v * 255 + 1e-9) AS INT) AS u8 FROM px")
def sink_png_colour(spark, sf):
    """Colour PNG files, one a frame, below folders; read by Spark's image reader."""
    folder = work.shared_path(spark)
    S.write_images(FR.as_bytes(frames(spark, sf), _path(".png")), folder)
    back = FR.from_bytes(S.read_images(spark, folder), F.regexp_extract("path", "frame_([0-9]+)", 1).cast("long"))
    return FR.pixels(back).select("img", "y", "x", "c", F.round(F.col("v") * 255).cast("int").alias("u8"))


@query("decode_folder", f"""WITH {_FR} SELECT 'part' || img % 5 || '/frame_' || img || '.png' AS path, CAST(max(y) + 1 AS INT) AS h, CAST(max(x) + 1 AS INT) AS w, 3 AS channels, true AS ok,
    CAST(sum(floor(v * 255 + 1e-9)) AS BIGINT) AS total FROM px GROUP BY img
    UNION ALL SELECT 'broken_' || p_partkey || '.png', -1, -1, -1, false, 0 FROM part WHERE p_partkey % 50 = 1""")
def decode_folder(spark, sf):
    """A folder with whole and broken files, decoded by Spark's image reader; broken ones are kept as such."""
    from ..sources import images as I

    folder = work.shared_path(spark)
    S.write_images(FR.as_bytes(frames(spark, sf), _path(".png")), folder)
    _broken(table(spark, sf, "part").where("p_partkey % 50 = 1").select(F.concat(F.lit("broken_"), "p_partkey", F.lit(".png")).alias("path")), folder)
    rows = I.decode(spark, folder, "keep", recursive=True)
    total = lambda d: F.aggregate(F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.conv(F.hex(F.substring(d, i, F.lit(1))), 16, 10).cast("long")), F.lit(0).cast("long"), lambda s, v: s + v)
    path = F.regexp_extract("origin", "((?:part[0-9]/)?(?:frame|broken)_[0-9]+\\.png)$", 1)
    return rows.select(path.alias("path"), F.col("height").alias("h"), F.col("width").alias("w"), F.col("nChannels").alias("channels"), "ok", F.when(F.col("ok"), total(F.col("data"))).otherwise(0).alias("total"))


def _broken(paths, folder):
    """Files that aren't images, in place of broken ones."""
    def run(batches):
        fs, root = S.located(folder)
        for b in FR.pieces(batches):
            for p in b["path"].to_pylist():
                with fs.open_output_stream(f"{root}/{p}") as out:
                    out.write(b"\x89PNG\r\n\x1a\n" + p.encode())
            yield b

    paths.mapInArrow(run, "path string").count()


@query("model_slot", f"""WITH {_FR}, s AS (SELECT img, par, y, x, avg(v) AS s FROM px GROUP BY ALL)
    SELECT img, CASE par WHEN 1 THEN 'ValueError: 4 rows are too few' END AS error, CASE par WHEN 0 THEN count(*) FILTER (s >= 0.5) END AS n_on, 1 AS loads FROM s GROUP BY img, par""")
def model_slot(spark, sf):
    """A stand-in model that refuses low frames: their rows have the error.  loads: how often the row's worker loaded it."""
    slot = M.Slot("brightness", M.brightness_mask, (("sensitivity", 0.5), ("least_rows", 5)), batch_bytes=8192)
    out = M.applied(frames(spark, sf), slot)
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + v).cast("long")
    return out.select("img", "error", total.alias("n_on"), "loads")


@query("batch_zip", f"""WITH {_FR}, b AS (SELECT DISTINCT img, img // 5 AS batch, CAST(img % 5 AS INT) AS i FROM px),
    r AS (SELECT batch, i, img FROM b WHERE batch % 2 = 0 OR i = 0), n AS (SELECT batch, count(*) AS n FROM r GROUP BY ALL)
    SELECT b.batch, b.i, b.img AS left_img, r.img AS right_img FROM b JOIN n USING (batch) JOIN r ON r.batch = b.batch AND r.i = CASE n WHEN 1 THEN 0 ELSE b.i END""")
def batch_zip(spark, sf):
    """Batches of five frames: with a batch of as many pair by pair, with a batch of one each with it."""
    f = frames(spark, sf).select(F.floor(F.col("img") / 5).alias("batch"), (F.col("img") % 5).cast("int").alias("i"), F.struct("img").alias("frame"))
    out = FR.zipped(f, f.where("batch % 2 = 0 OR i = 0"))
    return out.select("batch", "i", F.col("left.img").alias("left_img"), F.col("right.img").alias("right_img"))


WORKFLOW = json.dumps({"nodes": {
    "1": {"class_type": "LoadImage", "inputs": {"image": "frames"}}, "2": {"class_type": "LoadImage", "inputs": {"image": "partners"}},
    "3": {"class_type": "ImageCrop", "inputs": {"image": ["2", 0], "width": 6, "height": 3, "x": 1, "y": 1}},
    "4": {"class_type": "ImageToMask", "inputs": {"image": ["3", 0], "channel": "green"}},
    "5": {"class_type": "ImageCompositeMasked", "inputs": {"destination": ["1", 0], "source": ["3", 0], "mask": ["4", 0], "x": 2, "y": 2, "resize_source": False}},
    "6": {"class_type": "ImageTile", "inputs": {"image": ["3", 0], "columns": 2, "rows": 2}},
    "7": {"class_type": "ResizeAndPadImage", "inputs": {"image": ["5", 0], "target_width": 16, "target_height": 16, "padding_color": "white", "interpolation": "area"}},
    "8": {"class_type": "Image Save", "inputs": {"images": ["7", 0]}}, "9": {"class_type": "Image Save", "inputs": {"images": ["6", 0]}},
    "10": {"class_type": "UnknownModel", "inputs": {"image": ["9", 0]}}}})


@query("workflow_run", f"""WITH {_FR}, pt AS (SELECT CASE WHEN img % 2 = 0 THEN img + 1 ELSE img - 1 END AS img, y, x, c, v FROM px),
    cr AS MATERIALIZED (SELECT img, CAST(y - 1 AS INT) AS y, CAST(x - 1 AS INT) AS x, c, v FROM pt WHERE y BETWEEN 1 AND 3 AND x BETWEEN 1 AND 6 AND img IN (SELECT img FROM px)),
    co AS MATERIALIZED (SELECT p.img, p.par, p.y, p.x, p.c, coalesce(p.v * (1 - m.v) + s.v * m.v, p.v) AS v FROM px p LEFT JOIN cr s ON s.img = p.img AND s.y = p.y - 2 AND s.x = p.x - 2 AND s.c = p.c
      LEFT JOIN cr m ON m.img = p.img AND m.y = p.y - 2 AND m.x = p.x - 2 AND m.c = 1 WHERE p.img IN (SELECT img FROM cr)),
    z AS (SELECT par, h, w, CAST(greatest(1, round_even(h * least(16.0{_D} / h, 16.0{_D} / w), 0)) AS INT) AS th, CAST(greatest(1, round_even(w * least(16.0{_D} / h, 16.0{_D} / w), 0)) AS INT) AS tw FROM dims),
    {_scale_taps("ky", "area", "SELECT par, h, th FROM z")}, {_scale_taps("kx", "area", "SELECT par, w, tw FROM z")}, {_along("co", "re", "ky", "kx")},
    bx AS (SELECT i.img, CAST(a.y AS INT) AS y, CAST(b.x AS INT) AS x, CAST(d.c AS INT) AS c, coalesce(r.v, 1) AS v FROM (SELECT DISTINCT img, par FROM co) i JOIN z USING (par), range(16) a(y), range(16) b(x), range(3) d(c)
      LEFT JOIN re r ON r.img = i.img AND r.y = a.y - (16 - th) // 2 AND r.x = b.x - (16 - tw) // 2 AND r.c = d.c)
    SELECT img, '8' AS node, y, x, c, round(v, {DIGITS}) + 0.0 AS v FROM bx
    UNION ALL SELECT img, '9', CAST(y + 3 * a AS INT), CAST(x + 6 * b AS INT), c, round(v, {DIGITS}) + 0.0 FROM cr, range(2) p(a), range(2) q(b)""")
def workflow_run(spark, sf):
    """A workflow file of crop, mask, composite, box and tile over each frame and its partner; a node that no save node needs isn't run."""
    df = frames(spark, sf)
    out = W.run(WORKFLOW, {"1": df, "2": partners(df)})
    saved = out.where("error is null")
    parts = [shown(saved.where(F.col("node") == n)).withColumn("node", F.lit(n)) for n in ("8", "9")]
    return parts[0].unionByName(parts[1]).select("img", "node", "y", "x", "c", "v")
