"""Whole stages on panoramas: blurring what detectors find, and finishing edited images.

Models are slots; boxes between them are rows.  Every stage is one or two joins by image, whatever
the number of kernels it goes through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import contours, scaling, sky, sphere
from ..functions import kernels as K
from . import boxes as B
from . import frames as FR
from . import models as M
from .raster import kernel_of_sigma

SIDES = "FRBL"


def checked(what: str, **rules: bool) -> None:
    """Raises a ValueError that names the parameters whose rules don't hold."""
    bad = [name for name, holds in rules.items() if not holds]
    if bad:
        raise ValueError(f"{what}: out of range: {', '.join(bad)}")


#: Fixed colours of the annotations: red, green, blue of faces and of plates.
COLOURS = {"F": (24 / 255, 180 / 255, 24 / 255), "LP": (1.0, 0.0, 0.0)}
_BOX = "face string, x1 double, y1 double, x2 double, y2 double, conf double"


def cube_rows(frames: DataFrame, n: int, faces: str = SIDES) -> DataFrame:
    """A frame's columns and face: one row for each cube face of each panorama."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            ids, out = [], []
            for img, a in zip(b["img"].to_pylist(), FR.arrays(b), strict=True):
                ids += [img] * len(faces)
                out += list(sphere.faces_of(a, n, faces)) if faces else []
            yield FR.batch_of(ids, out, {"face": pa.array(list(faces) * (len(ids) // max(len(faces), 1)), pa.string())})

    return frames.select(*FR.COLUMNS).mapInArrow(run, f"{FR.FRAME}, face string")


def detections(faces: DataFrame, slots: dict[str, M.Slot], n: int, least: dict[str, float], most: float | None = 0.5) -> DataFrame:
    """(image, face, typ, x1, y1, x2, y2, conf, error) of the boxes that the slots find on cube faces (``cube_rows``).

    ``slots`` has a model for each type, which gives rows of five numbers (x1, y1, x2, y2, conf) for a face.
    Boxes below the type's ``least`` confidence go, and those that overlap a better one by more than
    ``most``; faces (F) are rounded half to even, others cut; empty ones go.  A face on which a
    model fails gives one row with the error and no box.  Faces are made and models called once: no branch reads them again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches, M.MODEL_ROWS, max(s.batch_bytes for s in slots.values())):
            ids, names, inputs = b["img"].to_pylist(), b["face"].to_pylist(), FR.arrays(b)
            rows = []
            for typ, slot in slots.items():
                for img, face, (result, error) in zip(ids, names, slot.results(inputs), strict=True):
                    if error is not None:
                        rows.append((img, face, typ, None, None, None, None, None, error))
                    else:
                        flat = np.asarray(result, np.float64).ravel()
                        rows += [(img, face, typ, *r, None) for r in flat[: flat.size // 5 * 5].reshape(-1, 5).tolist()]
            cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    kinds = {"image": pa.int64(), **dict.fromkeys(("face", "typ"), pa.string()), **dict.fromkeys(("x1", "y1", "x2", "y2", "conf"), pa.float64()), "error": pa.string()}
    schema = "image long, face string, typ string, x1 double, y1 double, x2 double, y2 double, conf double, error string"
    failed = F.col("error").isNotNull()
    found = faces.select(*FR.COLUMNS, "face").mapInArrow(run, schema)
    bound = F.element_at(F.create_map(*[F.lit(x) for typ in slots for x in (typ, float(least[typ]))]), F.col("typ"))
    found = found.where(failed | (F.col("conf") >= bound))
    if most is not None:  # a row with an error is alone in its group
        found = B.suppressed(found, ["image", "face", "typ"], most, ["x1", "y1", "x2", "y2"])
    sides = [F.when(~failed, F.col(c)).alias(c) for c in ("x1", "y1", "x2", "y2")]
    return B.clipped(found, n, n, rounding=F.col("typ") == "F", keep=failed).select("image", "face", "typ", *sides, "conf", "error")


@dataclass(frozen=True)
class Blur:
    """How found regions are blurred: see ``blurred``."""

    mask_threshold: float = 0.3
    mask_feather: float = 3.0
    sigma: float = 12.0
    scope: str = "roi"
    pad: int = 24
    min_area: int = 64
    roi_threshold: float = 0.1
    least_contour: float = 12.0

    def __post_init__(self):
        checked("blur", mask_threshold=0 <= self.mask_threshold <= 1, mask_feather=self.mask_feather >= 0, sigma=self.sigma > 0, scope=self.scope in ("roi", "full"),
                pad=self.pad >= 0, min_area=self.min_area >= 0, roi_threshold=0 < self.roi_threshold <= 1, least_contour=self.least_contour >= 0)


def region_mask(found: list[tuple[str, int, int, int, int]], n: int, h: int, w: int) -> np.ndarray:
    """(boxes, h, w): boxes of cube faces as soft masks in the panorama."""
    if not found:
        return np.zeros((0, h, w))
    cube = np.zeros((6, n, n, len(found)))  # a channel for each box: the way to the panorama is the same for all
    for k, (face, x1, y1, x2, y2) in enumerate(found):
        cube[sphere.FACES.index(face), y1:y2, x1:x2, k] = 1
    return np.ascontiguousarray(np.moveaxis(sphere.panorama_of(cube, h, w), -1, 0))


def blurred_frame(a: np.ndarray, masks: np.ndarray, how: Blur) -> np.ndarray:
    """A panorama blurred by the union of its regions' masks: around each component, or in the whole."""
    if not len(masks):
        return a
    mask = np.clip(masks.max(axis=0), 0, 1)
    if how.mask_threshold > 0:
        mask = (mask >= how.mask_threshold).astype(float)
    if how.mask_feather > 0:
        mask = np.clip(K.convolve(mask, kernel_of_sigma(how.mask_feather)), 0, 1)
    if how.scope == "roi":
        return K.soft_region_blur(a, mask, kernel_of_sigma(how.sigma), how.pad, how.min_area, how.roi_threshold)
    m = mask[..., None]
    return a * (1 - m) + K.convolve(a, kernel_of_sigma(how.sigma)) * m


def blurred(frames: DataFrame, found: DataFrame, n: int, how: Blur = Blur(), annotate: bool = False) -> DataFrame:
    """Panoramas with what ``detections`` found in them blurred: a frame's columns, face_boxes, lp_boxes, error; with ``annotate`` also drawn (array).

    An image without boxes stays as it is.  One with an error isn't given out unblurred: it has the error and no frame.
    """
    box = F.struct("face", "x1", "y1", "x2", "y2", "conf", "typ")
    by_image = found.groupBy("image").agg(
        F.sort_array(F.collect_list(F.when(F.col("error").isNull(), box))).alias("boxes"), F.min("error").alias("error"),
        F.count_if(F.col("error").isNull() & (F.col("typ") == "F")).alias("face_boxes"), F.count_if(F.col("error").isNull() & (F.col("typ") != "F")).alias("lp_boxes"))
    joined = frames.select(*FR.COLUMNS).join(by_image, frames["img"] == by_image["image"], "left").drop("image")
    empty = F.array().cast(by_image.schema["boxes"].dataType)
    joined = joined.select(*FR.COLUMNS, F.coalesce("boxes", empty).alias("boxes"), F.coalesce("face_boxes", F.lit(0)).alias("face_boxes"), F.coalesce("lp_boxes", F.lit(0)).alias("lp_boxes"), "error")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            out, drawn = [], []
            for a, boxes, error in zip(FR.arrays(b), b["boxes"].to_pylist(), b["error"].to_pylist(), strict=True):
                if error is not None:
                    out.append(np.empty((0, 0, 0)))
                    drawn.append(None)
                    continue
                masks = region_mask([(r["face"], r["x1"], r["y1"], r["x2"], r["y2"]) for r in boxes], n, *a.shape[:2])
                out.append(blurred_frame(a, masks, how))
                shown = a
                for r, mask in zip(boxes, masks, strict=True) if annotate else ():
                    shown = contours.annotated(shown, mask >= how.mask_threshold, f"{r['typ']} {r['conf']:.2f}", COLOURS[r["typ"]], how.least_contour)
                drawn.append(shown.ravel() if annotate else None)
            yield FR.batch_of(b["img"].to_pylist(), out, {
                "face_boxes": b["face_boxes"], "lp_boxes": b["lp_boxes"], "error": b["error"], "drawn": pa.array(drawn, pa.list_(pa.float64()))})

    done = joined.mapInArrow(run, f"{FR.FRAME}, face_boxes long, lp_boxes long, error string, drawn array<double>")
    return done if annotate else done.drop("drawn")


@dataclass(frozen=True)
class Finish:
    """How an edited panorama is finished: see ``finished``."""

    fov: tuple[float, float] = (70.0, 70.0)
    yaw: float = 180.0
    pitch: float = 50.0
    top_feather: int = 10
    seam: int = 40
    seam_pad: int = 128
    seam_ramp: int = 30
    seam_sigma: float = 3.0
    dilation: int = 1
    blur_radius: float = 10.0
    levels: int = 7

    def __post_init__(self):
        checked("finish", fov=all(0 < f < 180 for f in self.fov), pitch=-90 <= self.pitch <= 90, top_feather=self.top_feather >= 0, seam=self.seam > 0, seam_pad=self.seam_pad >= 0,
                seam_ramp=self.seam_ramp >= 0, seam_sigma=self.seam_sigma >= 0, dilation=self.dilation >= 0, blur_radius=self.blur_radius >= 0, levels=self.levels >= 0)


def finished_frame(a: np.ndarray, new_sky: np.ndarray | None, mask: np.ndarray | None, inpaint: Callable, hole: np.ndarray, how: Finish) -> np.ndarray:
    """Sky replaced where there are a sky and its mask, the view to the top repaired, then the seam."""
    if new_sky is not None and mask is not None:
        a = sky.replaced(a, new_sky, mask, how.dilation, how.blur_radius, how.levels)
    a = sphere.repaired_view(a, inpaint, hole, how.fov, how.yaw, how.pitch, how.top_feather)
    return K.repaired_seam(a, inpaint, how.seam, how.seam_pad, how.seam_ramp, how.seam_sigma)


def finished(jobs: DataFrame, frames: DataFrame, hole: np.ndarray, inpaint: Callable[[np.ndarray, np.ndarray], np.ndarray], how: Finish = Finish(), strict: bool = True) -> DataFrame:
    """Finished panoramas of ``jobs`` (img, sky, mask: ids of frames, or null): a frame's columns and error.

    A job without sky and mask is only repaired.  One whose sky or mask is named but has no frame, or which has one of
    them only, fails all jobs before any work (``strict``), or gives a row with the error and no frame.
    ``inpaint`` gets a view and the weight of what is to be filled.  The mask is its frame's first channel.
    """
    side = lambda name: frames.select(F.col("img").alias(f"{name}_img"), *[F.col(c).alias(f"{c}_{name}") for c in FR.COLUMNS[1:]])
    base, new, mask = (side(x) for x in ("base", "sky", "mask"))
    rows = jobs.join(base, jobs["img"] == base["base_img"]).join(new, jobs["sky"] == new["sky_img"], "left").join(mask, jobs["mask"] == mask["mask_img"], "left")
    lacks = lambda name: F.when(F.col(name).isNotNull() & F.col(f"{name}_img").isNull(), f"missing {name}")
    error = F.coalesce(lacks("sky"), lacks("mask"), F.when(F.col("sky").isNull() != F.col("mask").isNull(), "a sky and a mask go together"))
    rows = rows.withColumn("error", error)
    if strict:
        bad = rows.where("error is not null").select(F.concat_ws(": ", F.col("img").cast("string"), "error").alias("e")).limit(21).collect()
        if bad:
            raise ValueError("\n".join([r.e for r in bad[:20]] + ["... and more"] * (len(bad) > 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            sides = [_some(b, f"_{x}") for x in ("base", "sky", "mask")]
            out = [np.empty((0, 0, 0)) if e is not None else finished_frame(a, s, None if m is None else m[..., 0], inpaint, hole, how)
                   for a, s, m, e in zip(*sides, b["error"].to_pylist(), strict=True)]
            yield FR.batch_of(b["img"].to_pylist(), out, {"error": b["error"]})

    keep = [f"{c}_{x}" for x in ("base", "sky", "mask") for c in FR.COLUMNS[1:]]
    return rows.select(jobs["img"], *keep, "error").mapInArrow(run, f"{FR.FRAME}, error string")


def _some(b: pa.RecordBatch, suffix: str) -> list[np.ndarray | None]:
    """Frames of a batch, None where there is none."""
    shapes = zip(*[b[f"{c}{suffix}"].to_pylist() for c in ("h", "w", "c")], strict=True)
    return [None if d.as_py() is None else np.array(d.as_py()).reshape(s) for d, s in zip(b[f"data{suffix}"], shapes, strict=True)]


@dataclass(frozen=True)
class Tiles:
    """How panoramas are cut for a segmentation model: see ``tiled_masks``."""

    height: int = 1000
    width: int = 2000
    rows: int = 1
    cols: int = 2
    ratio: float = 0.0
    more_x: int = 30
    more_y: int = 0
    pad: int = 20
    dilation: int = 3
    square: bool = True

    def __post_init__(self):
        checked("tiles", rows=self.rows > 0, cols=self.cols > 0, ratio=0 <= self.ratio < 1, more_x=self.more_x >= 0, more_y=self.more_y >= 0, pad=self.pad >= 0, dilation=self.dilation >= 0)


def tiled_masks(frames: DataFrame, whole: M.Slot, spots: M.Slot, how: Tiles = Tiles()) -> DataFrame:
    """(img, h, w, c, data, error): the mask of each panorama, from two models that see its tiles.

    Panoramas are resized (sides of 0 keep them), their edges repeated up to whole tiles, and cut into tiles that overlap; each is a
    row, with ``pad`` black pixels around it, so the tiles of an image may be in several tasks.  A tile's mask
    is the larger of the two models', that of ``spots`` grown by ``dilation``; where tiles overlap the
    larger counts.  The rows * cols masks of an image meet again.  With ``square`` the mask lies in the middle of
    a square.  An image with a tile on which a model fails has an error and no mask.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            ids, out, more = [], [], []
            for img, a in zip(b["img"].to_pylist(), FR.arrays(b), strict=True):
                if how.height > 0 and how.width > 0:
                    a = np.clip(scaling.resized(a, how.height, how.width, "lanczos"), 0, 1)
                h, w = a.shape[:2]
                a = scaling.padded(a, 0, -h % how.rows, 0, -w % how.cols, "edge")
                for y1, y2 in scaling.windows(a.shape[0], how.rows, how.ratio, how.more_y):
                    for x1, x2 in scaling.windows(a.shape[1], how.cols, how.ratio, how.more_x):
                        ids.append(img)
                        out.append(scaling.padded(a[y1:y2, x1:x2], how.pad, how.pad, how.pad, how.pad, "zero"))
                        more.append((y1, x1, h, w))
            names = ("top", "left", "height", "width")
            yield FR.batch_of(ids, out, {n: pa.array([m[k] for m in more], pa.int32()) for k, n in enumerate(names)})

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches, M.MODEL_ROWS, max(whole.batch_bytes, spots.batch_bytes)):
            tiles = FR.arrays(b)
            out, errors = [], []
            for (sky_, e1), (spot, e2) in zip(whole.results(tiles), spots.results(tiles), strict=True):
                errors.append(e1 or e2)
                if errors[-1]:
                    out.append(np.empty((0, 0)))
                    continue
                mask = np.maximum(sky_, K.extreme(spot, how.dilation) if how.dilation else spot)
                out.append(scaling.unpadded(mask, how.pad, how.pad, how.pad, how.pad))
            yield FR.batch_of(b["img"].to_pylist(), out, {**{n: b[n] for n in ("top", "left", "height", "width")}, "error": pa.array(errors, pa.string())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            out = []
            for row in b.select(["tiles", "error"]).to_pylist():
                if row["error"] is not None:
                    out.append(np.empty((0, 0)))
                    continue
                h, w = row["tiles"][0]["height"], row["tiles"][0]["width"]
                mask = np.zeros((h + -h % how.rows, w + -w % how.cols))
                for t in row["tiles"]:
                    part = mask[t["top"] : t["top"] + t["h"], t["left"] : t["left"] + t["w"]]
                    np.maximum(part, np.array(t["data"]).reshape(t["h"], t["w"]), out=part)
                mask = np.clip(mask[:h, :w], 0, 1)
                out.append(scaling.padded(mask, *scaling.to_square(h, w), "zero") if how.square else mask)
            yield FR.batch_of(b["img"].to_pylist(), out, {"error": b["error"]})

    place = "top int, left int, height int, width int"
    tiles = frames.select(*FR.COLUMNS).mapInArrow(cut, f"{FR.FRAME}, {place}").mapInArrow(model, f"{FR.FRAME}, {place}, error string")
    by_image = tiles.groupBy("img").agg(F.sort_array(F.collect_list(F.struct("top", "left", "h", "w", "height", "width", "data"))).alias("tiles"), F.min("error").alias("error"))
    return by_image.mapInArrow(join, f"{FR.FRAME}, error string")


def anonymized_frame(a: np.ndarray, boxes: list[tuple[int, int, int, int]], mode: str, strength: float = 0.5, factor: int = 10) -> np.ndarray:
    """A frame with its boxes (x1, y1, x2, y2) made unreadable, one after the other, each on what is there so far.

    soft: a blur as wide as ``strength`` of the box's shorter side.  pixelate: cells of about ``factor`` pixels, each
    its mean; boxes of a single row or column stay.
    """
    if mode not in ("soft", "pixelate"):
        raise ValueError(f"unknown mode: {mode}")
    out = a.copy()
    for x1, y1, x2, y2 in boxes:
        part = out[y1:y2, x1:x2]
        h, w = part.shape[:2]
        if not h or not w:
            continue
        if mode == "soft":
            part[:] = K.convolve(part.copy(), K.soft_kernel(h, w, strength))
        elif h > 1 and w > 1:
            small = scaling.resized(part, max(1, h // factor), max(1, w // factor), "area")
            part[:] = small[np.arange(h) * small.shape[0] // h][:, np.arange(w) * small.shape[1] // w]
    return out


def anonymized(frames: DataFrame, boxes: DataFrame, mode: str, strength: float = 0.5, factor: int = 10) -> DataFrame:
    """Frames with their boxes (image, x1, y1, x2, y2 within the frame, conf, typ) made unreadable: faces first, then better ones first.

    A frame without boxes stays as it is.
    """
    order = F.struct(F.when(F.col("typ") == "F", 0).otherwise(1).alias("o"), (-F.col("conf")).alias("c"), "x1", "y1", "x2", "y2")
    by_image = boxes.groupBy("image").agg(F.sort_array(F.collect_list(order)).alias("boxes"))
    joined = frames.select(*FR.COLUMNS).join(by_image, frames["img"] == by_image["image"], "left").drop("image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            out = [anonymized_frame(a, [(r["x1"], r["y1"], r["x2"], r["y2"]) for r in found or ()], mode, strength, factor)
                   for a, found in zip(FR.arrays(b), b["boxes"].to_pylist(), strict=True)]
            yield FR.batch_of(b["img"].to_pylist(), out)

    return joined.mapInArrow(run, FR.FRAME)
