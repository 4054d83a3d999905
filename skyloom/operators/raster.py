"""Raster algebra on pixel relations (img, y, x, v).

A pixel relation is for small rasters that come as pixels, and for checks; whole frames
go through the array kernels of ``skyloom.functions.kernels``, one image a row.  Windows
are within an image, so work is dealt by image.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("img", "y", "x")


def reflect(i: Column, n: int) -> Column:
    """Index into 0..n-1 mirrored at the edges, which aren't repeated."""
    m = F.pmod(i, F.lit(max(1, 2 * (n - 1))))
    return F.when(m < n, m).otherwise(2 * (n - 1) - m)


def _frame(axis: str, r: int) -> Window:
    other = "x" if axis == "y" else "y"
    return Window.partitionBy("img", other).orderBy(axis).rowsBetween(-r, r)


def dilated(px: DataFrame, r: int = 1) -> DataFrame:
    """The maximum over (2r+1) x (2r+1); what lies outside never wins."""
    return px.withColumn("v", F.max("v").over(_frame("x", r))).withColumn("v", F.max("v").over(_frame("y", r)))


def eroded(px: DataFrame, r: int = 1) -> DataFrame:
    return px.withColumn("v", F.min("v").over(_frame("x", r))).withColumn("v", F.min("v").over(_frame("y", r)))


def taps(radius: int, sigma: float) -> list[tuple[int, float]]:
    """Gaussian weights by offset; they add up to 1."""
    raw = [(i, math.exp(-(i * i) / (2 * sigma * sigma))) for i in range(-radius, radius + 1)]
    total = sum(w for _, w in raw)
    return [(i, w / total) for i, w in raw]


def kernel_of_radius(r: float) -> list[tuple[int, float]]:
    """Radius int(r), sigma r; none below 0.5."""
    return taps(int(r), r) if r >= 0.5 else [(0, 1.0)]


def radius_taps(r: Column) -> Column:
    """The kernel of a radius that is a column: an array of (d, w), in whole-stage code."""
    half = F.when(r < 0.5, 0).otherwise(F.floor(r)).cast("int")
    raw = F.transform(F.sequence(-half, half), lambda d: F.struct(d.alias("d"), F.when(r < 0.5, 1.0).otherwise(F.exp(-(d * d) / (2 * r * r))).alias("w")))
    total = F.aggregate(raw, F.lit(0.0), lambda s, t: s + t["w"])
    return F.transform(raw, lambda t: F.struct(t["d"].alias("d"), (t["w"] / total).alias("w")))


def kernel_of_sigma(sigma: float) -> list[tuple[int, float]]:
    sigma = max(sigma, 0.1)
    return taps(max(1, round(3 * sigma)), sigma)


def kernel_of_feather(f: int) -> list[tuple[int, float]]:
    """Width 2f + 1, with the usual sigma for a width."""
    return taps(f, 0.3 * (f - 1) + 0.8)


def _lines(px: DataFrame, axis: str) -> DataFrame:
    """Each line along ``axis`` as one array, in order."""
    other = "x" if axis == "y" else "y"
    s = F.transform(F.sort_array(F.collect_list(F.struct(axis, "v"))), lambda p: p["v"])
    return px.groupBy("img", other).agg(s.alias("line"))


def _spread(lines: DataFrame, axis: str) -> DataFrame:
    other = "x" if axis == "y" else "y"
    return lines.select("img", other, F.posexplode("line").alias(axis, "v")).select(*KEYS, "v")


def blurred(px: DataFrame, kernel: list[tuple[int, float]], h: int, w: int) -> DataFrame:
    """Separable convolution with mirrored edges, a line as an array: along x, then y."""
    if len(kernel) == 1:
        return px
    for axis, n in (("x", w), ("y", h)):
        at = lambda line, i: F.element_at(line, (reflect(i, n) + 1).cast("int"))  # noqa: E731, B023
        def line_sum(line: Column) -> Column:
            def one(i: Column) -> Column:
                out = F.lit(0.0)
                for d, k in kernel:
                    out = out + at(line, i + d) * k  # noqa: B023
                return out

            return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), one)  # noqa: B023

        px = _spread(_lines(px, axis).withColumn("line", line_sum(F.col("line"))), axis)
    return px
