"""Detection boxes: clipping, thresholds, counts, rasterising, regions to blur."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scaling import PREFERRED


def _clip(x1: Column, y1: Column, x2: Column, y2: Column, w: int, h: int) -> list[Column]:
    low = lambda v, n: F.greatest(F.lit(0), F.least(v, F.lit(n - 1)))
    high = lambda v, n: F.greatest(F.lit(0), F.least(v, F.lit(n)))
    return [low(x1, w).alias("x1"), low(y1, h).alias("y1"), high(x2, w).alias("x2"), high(y2, h).alias("y2")]


def clipped(boxes: DataFrame, w: int, h: int, rounding: bool | Column, keep: Column | None = None) -> DataFrame:
    """Integer boxes within the image; empty ones go, unless ``keep``.  ``rounding``: half to even, else towards zero; or a column that says so."""
    rounds = rounding if isinstance(rounding, Column) else F.lit(rounding)
    whole = lambda c: F.when(rounds, F.bround(c).cast("int")).otherwise(c.cast("int"))
    rest = [c for c in boxes.columns if c not in ("x1", "y1", "x2", "y2")]
    corners = [whole(F.col(c)) for c in ("x1", "y1", "x2", "y2")]
    some = F.expr("x2 > x1 AND y2 > y1")
    return boxes.select(*rest, *_clip(*corners, w, h)).where(some if keep is None else some | keep)


def confident(boxes: DataFrame, least: dict[str, float]) -> DataFrame:
    """Boxes whose confidence reaches the least of their kind (typ); kinds without one go."""
    bound = F.when(F.lit(False), F.lit(None).cast("double"))
    for typ, v in least.items():
        bound = bound.when(F.col("typ") == typ, F.lit(v))
    return boxes.where(F.col("conf") >= bound)


def per_image(boxes: DataFrame) -> DataFrame:
    return boxes.groupBy("image").agg(
        F.count_if(F.col("typ") == "F").alias("face_boxes"), F.count_if(F.col("typ") == "LP").alias("lp_boxes"),
        F.count("*").alias("total_boxes"))


def rasterized(boxes: DataFrame, cell: int) -> DataFrame:
    """Cells (image, face, cx, cy) that a box covers: each box emits its own cells, so no range join."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / cell).cast("int"), F.floor((F.col(b) - 1) / cell).cast("int"))
    rows = boxes.select("image", "face", F.explode(span("x1", "x2")).alias("cx"), "y1", "y2")
    return rows.select("image", "face", "cx", F.explode(span("y1", "y2")).alias("cy")).distinct()


def regions(boxes: DataFrame, w: int, h: int, pad: int, min_area: int) -> DataFrame:
    """Boxes of at least ``min_area``, padded and clipped: the regions to blur."""
    big = boxes.where((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= min_area)
    rest = [c for c in boxes.columns if c not in ("x1", "y1", "x2", "y2")]
    return big.select(
        *rest, F.greatest(F.col("x1") - pad, F.lit(0)).alias("x1"), F.greatest(F.col("y1") - pad, F.lit(0)).alias("y1"),
        F.least(F.col("x2") + pad, F.lit(w)).alias("x2"), F.least(F.col("y2") + pad, F.lit(h)).alias("y2"))


def tile_windows(dims: DataFrame, rows: int, cols: int, ratio: float, px: int) -> DataFrame:
    """Windows (i, x1, y1, x2, y2) of a tile grid over images (w, h), with overlap.

    Tiles grow by the overlap to the right and below, all but the first also start
    earlier by it, and a window past the edge is shifted back.
    """
    def axis(dim: str, n: int, at: str) -> list[Column]:
        tile = F.floor(F.col(dim) / n).cast("int")
        over = F.when(F.lit(n == 1), 0).otherwise(F.least(F.floor(tile / 2), F.floor(tile * ratio) + px)).cast("int")
        start = F.greatest(F.lit(0), F.col(at) * tile - F.when(F.col(at) > 0, over).otherwise(0))
        end = start + tile + over
        shift = F.greatest(F.lit(0), end - F.col(dim))
        return [F.greatest(F.lit(0), start - shift), end - shift]

    grid = dims.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    (x1, x2), (y1, y2) = axis("w", cols, "c"), axis("h", rows, "r")
    rest = [c for c in dims.columns]
    return grid.select(*rest, (F.col("r") * cols + F.col("c")).alias("i"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def preferred_crop(dims: DataFrame) -> DataFrame:
    """(id, x0, y0, cw, ch, tw, th) of images (id, w, h): the middle that is resized to the preferred size of the nearest shape."""
    sizes = F.array(*[F.struct(F.lit(w).alias("tw"), F.lit(h).alias("th")) for w, h in PREFERRED])
    shape = F.col("w") / F.col("h")
    near = F.array_min(F.transform(sizes, lambda s: F.struct(F.abs(shape - s["tw"] / s["th"]).alias("d"), s["tw"].alias("tw"), s["th"].alias("th"))))
    d = dims.withColumn("s", near).select("*", "s.tw", "s.th")
    wide = F.col("w") * F.col("th") > F.col("tw") * F.col("h")
    x0 = F.when(wide, F.bround((F.col("w") - F.col("h") * F.col("tw") / F.col("th")) / 2)).otherwise(0).cast("int")
    y0 = F.when(wide, 0).otherwise(F.bround((F.col("h") - F.col("w") * F.col("th") / F.col("tw")) / 2)).cast("int")
    return d.select("id", x0.alias("x0"), y0.alias("y0"), (F.col("w") - 2 * x0).cast("int").alias("cw"), (F.col("h") - 2 * y0).cast("int").alias("ch"), "tw", "th")


def labels(boxes: DataFrame) -> DataFrame:
    """With the text that an annotation shows."""
    return boxes.withColumn("label", F.format_string("%s %.2f", "typ", "conf"))


def aspect_crop(masks: DataFrame) -> DataFrame:
    """(id, x0, y0, cw, ch, tw, th) of masks (id, w, h) and targets (tw, th): sides are rounded half to even."""
    mask, target = F.col("w") / F.col("h"), F.col("tw") / F.col("th")
    cw = F.when(mask - target > 1e-6, F.bround(F.col("h") * target).cast("int")).otherwise(F.col("w"))
    ch = F.when(target - mask > 1e-6, F.bround(F.col("w") / target).cast("int")).otherwise(F.col("h"))
    start = lambda side, cut: F.greatest(F.lit(0), F.floor((F.col(side) - F.col(cut)) / 2)).cast("int")
    return masks.withColumn("cw", cw).withColumn("ch", ch).select(
        "id", start("w", "cw").alias("x0"), start("h", "ch").alias("y0"), "cw", "ch", "tw", "th")


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 where both are empty."""
    side = lambda lo, hi: F.greatest(F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]), F.lit(0))
    area = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    both = side("x1", "x2") * side("y1", "y2")
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def suppressed(boxes: DataFrame, keys: list[str], most: float, order: list[Column | str]) -> DataFrame:
    """The boxes of each group that overlap no better one that is kept by more than ``most``.

    Boxes come by confidence (conf), ties by ``order``.  A group is the boxes of one image and kind: it is
    one array, of as many boxes as the detector gives, and never leaves whole-stage code.
    """
    row = F.struct(-F.col("conf"), *order, *[F.col(c) for c in boxes.columns if c not in keys])
    names = [c for c in boxes.columns if c not in keys]
    whole = F.sort_array(F.collect_list(F.struct(row.alias("by"), F.struct(*names).alias("box"))))
    ranked = boxes.groupBy(*keys).agg(F.transform(whole, lambda r: r["box"]).alias("all"))
    kept = F.aggregate(
        "all", F.slice("all", 1, 0), lambda kept, b: F.when(F.exists(kept, lambda k: overlap(k, b) > most), kept).otherwise(F.array_append(kept, b)))
    return ranked.select(*keys, F.explode(kept).alias("b")).select(*[c if c in keys else F.col(f"b.{c}").alias(c) for c in boxes.columns])


def scaled(boxes: DataFrame, by: float) -> DataFrame:
    """Boxes grown or shrunk around their middles."""
    def ends(lo: str, hi: str) -> list[Column]:
        middle, half = (F.col(lo) + F.col(hi)) / 2, (F.col(hi) - F.col(lo)) / 2 * by
        return [middle - half, middle + half]

    (x1, x2), (y1, y2) = ends("x1", "x2"), ends("y1", "y2")
    return boxes.select(*[c for c in boxes.columns if c not in ("x1", "y1", "x2", "y2")], x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
