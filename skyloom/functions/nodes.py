"""Nodes as SQL table functions: parameters are checked and the result's columns named before anything runs.

    SELECT * FROM perspective_to_equirectangular(TABLE(frames), fov_w => 100.0, u_deg => 30.0)
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, SkipRestOfInputTableException, udtf  # noqa: F401
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from . import scaling, sphere


class Parameter:
    """A number with a default and bounds; whole numbers stay whole."""

    def __init__(self, default: float, least: float, most: float):
        self.default, self.least, self.most = default, least, most

    def value(self, name: str, given: object) -> float:
        whole = isinstance(self.default, int)
        if given is None or isinstance(given, bool) or whole and given != int(given):
            raise ValueError(f"{name} must be a {'whole ' if whole else ''}number")
        if not self.least <= float(given) <= self.most:
            raise ValueError(f"{name} goes from {self.least} to {self.most}")
        return int(given) if whole else float(given)


#: Fixed defaults and bounds of the projecting node.
PROJECTION = {
    "fov_w": Parameter(140.0, 1.0, 180.0), "fov_h": Parameter(140.0, 1.0, 180.0), "u_deg": Parameter(180.0, -180.0, 180.0),
    "v_deg": Parameter(-70.0, -90.0, 90.0), "feather": Parameter(10, 0, 200),
}
_SIDES = ("h", "w", "c")


def _checked(table: AnalyzeArgument, columns: tuple[str, ...], given: dict[str, AnalyzeArgument], known: dict[str, Parameter]) -> StructType:
    """The table's schema, if its columns and all parameters are right."""
    if not table.isTable:
        raise ValueError("the first argument is a table")
    for name, a in given.items():
        if name not in known:
            raise ValueError(f"unknown parameter {name}; there are {', '.join(known)}")
        if not a.isConstantExpression:
            raise ValueError(f"{name} must be a constant")
        known[name].value(name, a.value if not hasattr(a.value, "as_tuple") else float(a.value))
    missing = [c for c in columns if c not in table.dataType.fieldNames()]
    if missing:
        raise ValueError(f"the table lacks {', '.join(missing)}")
    return table.dataType


def _number(v: object) -> float:
    return float(v) if hasattr(v, "as_tuple") else v


def _frame(row, prefix: str = "") -> np.ndarray:
    return np.array(row[f"{prefix}data"], float).reshape([row[f"{prefix}{s}"] for s in _SIDES])


class PerspectiveToEquirectangular:
    """Lays the perspective frame of each row (p_h, p_w, p_c, p_data) into its panorama (h, w, c, data).

    All other columns stay; merged, patch_360 and mask are added.
    """

    @staticmethod
    def analyze(frames: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        columns = tuple(f"{p}{s}" for p in ("", "p_") for s in (*_SIDES, "data"))
        schema = _checked(frames, columns, given, PROJECTION)
        keep = [f for f in schema.fields if f.name not in ("data", "p_h", "p_w", "p_c", "p_data")]
        return AnalyzeResult(StructType([*keep, *[StructField(n, ArrayType(DoubleType())) for n in ("merged", "patch_360", "mask")]]))

    def eval(self, frames, **given):
        v = {k: p.value(k, _number(given.get(k, p.default))) for k, p in PROJECTION.items()}
        made = sphere.patched(_frame(frames), _frame(frames, "p_"), (v["fov_w"], v["fov_h"]), v["u_deg"], v["v_deg"], v["feather"])
        keep = [frames[c] for c in frames.__fields__ if c not in ("data", "p_h", "p_w", "p_c", "p_data")]
        yield (*keep, *[a.ravel().tolist() for a in made])


#: Sides of the resizing node: 0 asks for no bound.
SIZES = {"width": Parameter(512, 0, 65_535), "height": Parameter(512, 0, 65_535), "multiple_of": Parameter(1, 1, 512)}


class ResizeFrames:
    """Resizes the frame of each row (h, w, c, data) within bounds, in its shape; all other columns stay."""

    @staticmethod
    def analyze(frames: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        schema = _checked(frames, (*_SIDES, "data"), given, SIZES)
        keep = [f for f in schema.fields if f.name not in (*_SIDES, "data")]
        return AnalyzeResult(StructType([*keep, *[StructField(s, IntegerType()) for s in _SIDES], StructField("data", ArrayType(DoubleType()))]))

    def eval(self, frames, **given):
        v = {k: p.value(k, _number(given.get(k, p.default))) for k, p in SIZES.items()}
        a = _frame(frames)
        h, w = scaling.target_size(*a.shape[:2], v["height"], v["width"], multiple=v["multiple_of"])
        out = scaling.resized(a, h, w, "area")
        yield (*[frames[c] for c in frames.__fields__ if c not in (*_SIDES, "data")], h, w, a.shape[2], out.ravel().tolist())


NODES = {"perspective_to_equirectangular": PerspectiveToEquirectangular, "resize_frames": ResizeFrames}


def register(spark: SparkSession) -> None:
    """Makes the nodes callable from the session's SQL."""
    for name, node in NODES.items():
        spark.udtf.register(name, udtf(node))
