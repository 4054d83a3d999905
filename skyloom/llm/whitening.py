"""Whitening of embeddings by principal components of integer vectors.

An entry c counts as x = floor(256 * c).  The fit list is each distinct vector x
once: n vectors, S their sums by dimension.  Rows are centred as n * x - S in
integers, so exactly, and divided by n once; MLlib's ``RowMatrix`` sums their
Gramian on the executors, and only that d x d matrix reaches the driver, where
its eigenvectors are found.  They go back as a constant of the projecting task.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

STEPS = 256
#: Eigenvalues of no more than this share of the trace count as none.
NO_SPREAD = 1e-12
_FIT = "_x array<bigint>, centred array<double>"


def usable(vector: Column) -> Column:
    """False for a null or empty vector and for one with a null or non-finite entry."""
    d = lambda c: c.cast("double")
    finite = lambda c: c.isNotNull() & ~F.isnan(d(c)) & (F.abs(d(c)) < float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def stepped(vector: Column, steps: int = STEPS) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(steps)) * c.cast("double")).cast("bigint"))


def gramian(rows: DataFrame, vector: str) -> np.ndarray:
    """The sum of the outer products of the rows' vectors (array<double>)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(F.col(vector)).alias("v")), "v")
    return RowMatrix(vectors).computeGramianMatrix().toArray()


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums as 64-bit integers where they hold it, as Python's otherwise."""
    if max(n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)), n) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b["_x"], len(sums))
            centred = (_exact(x, n, sums) / n).astype(np.float64)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(sums))
            yield pa.record_batch([b["_x"], pa.ListArray.from_arrays(ends, pa.array(centred.ravel()))], names=["_x", "centred"])

    return run


def _projected(n: int, sums: list[int], axes: np.ndarray, roots: np.ndarray):
    """Adds ``deviation`` and ``whitened`` to batches (pandas) that hold ``_x``."""
    def run(frames):
        for p in frames:
            x = np.array(p["_x"].tolist(), np.int64).reshape(len(p), len(sums))
            off = _exact(x, n, sums)
            if off.dtype != object and len(sums) * int(np.abs(off).max(initial=0)) ** 2 >= 1 << 62:
                off = off.astype(object)
            p["deviation"] = [Decimal(int(v)) for v in (off * off).sum(axis=1)]
            p["whitened"] = list((off / n).astype(np.float64) @ axes / roots)
            yield p.drop(columns="_x")

    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4, steps: int = STEPS) -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped;
    repeated rows get their results each, and so do rows without an id.  All vectors
    must have one length (an error otherwise), and entries must fit 64 bits after the
    step.  ``deviation`` is exact, decimal(38, 0).  Components without spread (one
    distinct vector only, or fewer independent dimensions than components) have
    explained 0 (null where nothing varies) and whitened null.  Other columns are
    ignored, whatever their names.  An empty table gives an empty result.
    """
    vector = F.col(f"`{vec_col}`")
    base = rows.select(F.col(f"`{id_col}`").alias("_id"), stepped(F.when(usable(vector), vector), steps).alias("_x"))
    base = C.stored(base.where("_x is not null"))
    fit = C.stored(base.select("_x").distinct())
    n, low, high = fit.agg(F.count("*"), F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if low != high:
        raise ValueError(f"vectors have {low} to {high} entries")
    if not n:
        return _named(base.select(
            "_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]).where("false"), id_col)
    sums = [int(s) for _, s in sorted(
        fit.select(F.posexplode("_x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect())]
    covariance = gramian(fit.mapInArrow(_centred(n, sums), _FIT), "centred") / n
    values, axes = np.linalg.eigh(covariance)
    k = min(components, low)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    spread = values > NO_SPREAD * trace
    roots = np.where(spread, np.sqrt(np.where(spread, values, 1.0)), np.nan)
    project = _projected(n, sums, axes, roots)
    # The covariance of what the fit list becomes: centred again, so that nothing hides in the mean.
    white = fit.mapInPandas(project, "deviation decimal(38,0), whitened array<double>")
    w = [F.col("whitened")[i] for i in range(k) if spread[i]]
    pairs = [(i, j) for i in range(len(w)) for j in range(i + 1)]
    error = None
    if pairs:
        found = white.agg(*[F.covar_pop(w[i], w[j]) for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))
    share = F.array(*[F.lit(float(v / trace) if s else 0.0 if trace else None).cast("double") for v, s in zip(values, spread, strict=True)])
    out = base.mapInPandas(project, base.select("_id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")).schema)
    out = out.select("_id", "deviation", F.posexplode("whitened").alias("at", "w")).select(
        "_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", F.nanvl("w", F.lit(None).cast("double")).alias("whitened"),
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
    return _named(out, id_col)


def _named(out: DataFrame, id_col: str) -> DataFrame:
    return out.withColumnRenamed("_id", id_col)
