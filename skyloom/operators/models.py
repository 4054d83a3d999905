"""A slot for models over frames: loaded once in a worker, called by batches of a number of bytes.

A frame on which the model fails gives a row with the error; the job goes on.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scaling, sphere
from ..functions.kernels import extreme
from . import frames as FR

#: What a slot calls: frames in, one result for each.
Model = Callable[[list[np.ndarray]], list[np.ndarray]]
#: Frames that a task hands to a slot at once, at most; their bytes are the slot's.
MODEL_ROWS = 4096
#: Models of this worker process by (name, settings), and how often each was loaded.
_held: dict[tuple, Any] = {}
_loads: dict[tuple, int] = {}


@dataclass(frozen=True)
class Slot:
    """A model to be loaded by ``load(**settings)``, a function of a module; equal slots share a loaded model."""

    name: str
    load: Callable[..., Model]
    settings: tuple[tuple[str, Any], ...] = ()
    batch_bytes: int = 64 << 20

    def model(self) -> tuple[Model, int]:
        """The worker's model, loaded at the first call, and how often it was loaded (1, as long as it is kept)."""
        key = (self.name, self.settings)
        if key not in _held:
            _held[key] = self.load(**dict(self.settings))
            _loads[key] = _loads.get(key, 0) + 1
        return _held[key], _loads[key]

    def results(self, frames: list[np.ndarray]) -> list[tuple[np.ndarray | None, str | None]]:
        """(result, error) of each frame; if the model fails on a batch, its frames are tried one by one."""
        model, _ = self.model()
        out: list[tuple[np.ndarray | None, str | None]] = []
        for some in _by_bytes(frames, self.batch_bytes):
            try:
                found = model(some)
                if len(found) != len(some):
                    raise ValueError(f"{len(found)} results for {len(some)} frames")
                out += [(r, None) for r in found]
            except Exception as whole:  # noqa: BLE001  any failure of a model is a row
                if len(some) == 1:
                    out.append((None, f"{type(whole).__name__}: {whole}"))
                    continue
                for one in some:
                    try:
                        out.append((model([one])[0], None))
                    except Exception as e:  # noqa: BLE001
                        out.append((None, f"{type(e).__name__}: {e}"))
        return out


def _by_bytes(frames: list[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """The frames in order, in lists of at most ``most`` bytes, one frame at least."""
    some, size = [], 0
    for a in frames:
        if some and size + a.nbytes > most:
            yield some
            some, size = [], 0
        some.append(a)
        size += a.nbytes
    if some:
        yield some


def applied(frames: DataFrame, slot: Slot, keep: tuple[str, ...] = ()) -> DataFrame:
    """The slot's result for each frame (columns of a frame, null where it failed) and its error; columns ``keep`` stay.

    For supervision, loads says how often the row's worker (process) has loaded the model.
    """
    kept = [f for f in frames.schema if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches, MODEL_ROWS, slot.batch_bytes):
            found = slot.results(FR.arrays(b))
            _, loads = slot.model()
            n, failed = b.num_rows, pa.array([r is None for r, _ in found], pa.bool_())
            made = FR.batch_of(b["img"].to_pylist(), [np.empty((0, 0, 0)) if r is None else r for r, _ in found])
            cols = [made["img"], *[pc.if_else(failed, pa.scalar(None, made[c].type), made[c]) for c in FR.COLUMNS[1:]]]
            cols += [b[f.name] for f in kept] + [pa.array([e for _, e in found], pa.string()), pa.array([loads] * n, pa.int32()), pa.array([os.getpid()] * n, pa.int64())]
            yield pa.record_batch(cols, names=[*FR.COLUMNS, *[f.name for f in kept], "error", "loads", "worker"])

    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept)
    return frames.select(*FR.COLUMNS, *[f.name for f in kept]).mapInArrow(run, f"{FR.FRAME}{more}, error string, loads int, worker long")


def brightness_mask(sensitivity: float = 0.5, least_rows: int = 1) -> Model:
    """A deterministic stand-in for a segmentation model: pixels whose channels' mean reaches ``sensitivity``.

    Frames with fewer rows than ``least_rows`` are refused, as a model refuses what it can't read.
    """
    def run(frames: list[np.ndarray]) -> list[np.ndarray]:
        for a in frames:
            if a.shape[0] < least_rows:
                raise ValueError(f"{a.shape[0]} rows are too few")
        return [(a.mean(axis=2) >= sensitivity).astype(float) for a in frames]

    return run


def spread_brightness(reach: int = 1) -> Model:
    """A deterministic stand-in for a model that looks around: the largest mean of the channels within ``reach`` pixels."""
    return lambda frames: [extreme(a.mean(axis=2), reach) for a in frames]


def cube_masks(frames: DataFrame, slot: Slot, n: int, predict: str = "FRBLU", pad: int = 0, threshold: float | None = None) -> DataFrame:
    """(img, h, w, c, data, error): the panorama mask of each panorama, put together from masks of its cube faces.

    The slot sees each face of ``predict`` (n x n, with ``pad`` mirrored pixels around it), one a row, so the faces of
    an image may be in several tasks; other faces are zeros.  Six rows an image meet again.  An image with a face
    on which the slot fails has an error and no mask.
    """
    index = scaling.mirrored(n, pad)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            ids, faces, of, sides = [], [], [], []
            for img, a in zip(b["img"].to_pylist(), FR.arrays(b), strict=True):
                cube = sphere.faces_of(a, n)
                for f in predict:
                    ids.append(img)
                    of.append(f)
                    faces.append(cube[sphere.FACES.index(f)][index][:, index])
                    sides.append(a.shape[:2])
            yield FR.batch_of(ids, faces, {
                "face": pa.array(of, pa.string()), "height": pa.array([s[0] for s in sides], pa.int32()), "width": pa.array([s[1] for s in sides], pa.int32())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            masks = []
            for row in b.select(["faces", "height", "width"]).to_pylist():
                cube = np.zeros((6, n, n))
                for f in row["faces"]:
                    mask = np.array(f["data"]).reshape(f["h"], f["w"])[pad : pad + n, pad : pad + n]
                    cube[sphere.FACES.index(f["face"])] = mask if threshold is None else mask >= threshold
                masks.append(sphere.panorama_of(cube, row["height"], row["width"]))
            yield FR.batch_of(b["img"].to_pylist(), masks)

    found = applied(frames.mapInArrow(split, f"{FR.FRAME}, face string, height int, width int"), slot, ("face", "height", "width"))
    by_image = found.groupBy("img").agg(
        F.sort_array(F.collect_list(F.struct("face", "h", "w", "data"))).alias("faces"), F.first("height").alias("height"), F.first("width").alias("width"),
        F.min("error").alias("error"))
    good = by_image.where("error is null").mapInArrow(join, FR.FRAME).withColumn("error", F.lit(None).cast("string"))
    bad = by_image.where("error is not null").select("img", *[F.lit(None).cast(t).alias(c) for c, t in (("h", "int"), ("w", "int"), ("c", "int"), ("data", "array<double>"))], "error")
    return good.unionByName(bad)


def box_finder(limit: float, above: bool = True, off: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)) -> Model:
    """A deterministic stand-in for a detector: the box around all pixels whose channels' mean is at least (or at most) ``limit``.

    A box (x1, y1, x2, y2) is moved by ``off``; its confidence is the mean of those pixels.
    """
    def one(a: np.ndarray) -> np.ndarray:
        mean = a.mean(axis=2)
        y, x = np.nonzero(mean >= limit if above else mean <= limit)
        if not len(y):
            return np.empty((0, 5))
        return np.array([[x.min() + off[0], y.min() + off[1], x.max() + 1 + off[2], y.max() + 1 + off[3], mean[y, x].mean()]])

    return lambda frames: [one(a) for a in frames]
