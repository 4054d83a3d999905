"""Frames (img, h, w, c, data): one image a row, values by row, column and channel in [0, 1].

Work goes image by image through array kernels in Arrow batches; nothing is exploded into
pixels.  Operators on several frames join them by image first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import pieces

FRAME = "img long, h int, w int, c int, data array<double>"
COLUMNS = ("img", "h", "w", "c", "data")
_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int32())


def arrays(b: pa.RecordBatch, suffix: str = "") -> list[np.ndarray]:
    """The frames of a batch as (h, w, c) arrays."""
    data = b[f"data{suffix}"]
    flat, ends = data.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *data.value_lengths().to_pylist()])
    shapes = zip(b[f"h{suffix}"].to_pylist(), b[f"w{suffix}"].to_pylist(), b[f"c{suffix}"].to_pylist(), strict=True)
    return [flat[ends[k] : ends[k + 1]].reshape(shape) for k, shape in enumerate(shapes)]


def batch_of(ids: list, frames: list[np.ndarray], more: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    """A batch of frames; masks (h, w) have one channel."""
    frames = [a[..., None] if a.ndim == 2 else a for a in frames]
    sides = [[a.shape[k] for a in frames] for k in range(3)]
    cols = [pa.array(v, t) for v, t in zip([ids, *sides], _TYPES, strict=True)]
    ends = pa.array(np.cumsum([0, *[a.size for a in frames]]).astype(np.int32))
    values = np.concatenate([np.ascontiguousarray(a, np.float64).ravel() for a in frames]) if frames else np.empty(0)
    cols.append(pa.ListArray.from_arrays(ends, pa.array(values)))
    return pa.record_batch([*cols, *(more or {}).values()], names=[*COLUMNS, *(more or {})])


def mapped(frames: DataFrame, kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Each frame replaced by ``kernel`` of it."""
    return together(kernel, frames)


def together(kernel: Callable[..., np.ndarray], *relations: DataFrame) -> DataFrame:
    """``kernel`` of the frames that the relations have for an image; images that one of them lacks go."""
    joined = None
    for k, df in enumerate(relations):
        mine = df.select("img", *[F.col(c).alias(f"{c}_{k}") for c in COLUMNS[1:]])
        joined = mine if joined is None else joined.join(mine, "img")
    n = len(relations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            inputs = [arrays(b, f"_{k}") for k in range(n)]
            yield batch_of(b["img"].to_pylist(), [kernel(*one) for one in zip(*inputs, strict=True)])

    return joined.mapInArrow(run, FRAME)


def pixels(frames: DataFrame) -> DataFrame:
    """(img, y, x, c, v): for checks."""
    at = frames.select("img", "w", F.col("c").alias("n"), F.posexplode("data").alias("i", "v"))
    i, n, w = F.col("i"), F.col("n"), F.col("w")
    return at.select("img", F.floor(i / (w * n)).cast("int").alias("y"), (F.floor(i / n) % w).cast("int").alias("x"), (i % n).alias("c"), "v")


def as_bytes(frames: DataFrame, path: Column) -> DataFrame:
    """Rows of the image sink (path, height, width, channels, data): values times 255, truncated; gray or colour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data = [np.clip(a * 255 + 1e-9, 0, 255).astype(np.uint8).tobytes() for a in arrays(b)]
            yield pa.record_batch([b["path"], b["h"], b["w"], b["c"], pa.array(data, pa.binary())], names=["path", "height", "width", "channels", "data"])

    return frames.select(path.alias("path"), *COLUMNS[1:]).mapInArrow(run, "path string, height int, width int, channels int, data binary")


def from_bytes(images: DataFrame, img: Column) -> DataFrame:
    """Frames of image rows (height, width, channels, data)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            shapes = zip(b["height"].to_pylist(), b["width"].to_pylist(), b["channels"].to_pylist(), strict=True)
            yield batch_of(b["img"].to_pylist(), [np.frombuffer(d.as_py(), np.uint8).reshape(s) / 255 for d, s in zip(b["data"], shapes, strict=True)])

    return images.select(img.cast("long").alias("img"), "height", "width", "channels", "data").mapInArrow(run, FRAME)


def zipped(left: DataFrame, right: DataFrame) -> DataFrame:
    """(batch, i, left, right): the frames of two batches side by side; each relation has (batch, i, frame), i from 0.

    Batches of one size go pair by pair; a batch of one goes with every frame of the other.  Other sizes
    are an error.  Batches that one side lacks go.
    """
    count = lambda df, name: df.groupBy("batch").agg(F.count("*").alias(name))
    sizes = count(left, "n").join(count(right, "m"), "batch")
    fits = (F.col("n") == F.col("m")) | (F.least("n", "m") == 1)
    wrong = F.raise_error(F.format_string("batch %s has %d and %d frames", F.col("batch").cast("string"), "n", "m"))
    sizes = sizes.where(F.when(fits, F.lit(True)).otherwise(wrong.cast("boolean")))
    sizes = sizes.select("batch", (F.least("n", "m") == 1).alias("one"))
    side = lambda df, name: df.join(sizes, "batch").select(
        "batch", F.when(F.col("one"), 0).otherwise(F.col("i")).alias("k"), F.col("i").alias(f"i_{name}"), F.col("frame").alias(name))
    return side(left, "left").join(side(right, "right"), ["batch", "k"]).select("batch", F.greatest("i_left", "i_right").alias("i"), "left", "right")
