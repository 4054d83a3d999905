"""Hard negatives by bit-sliced integer products.

A component c counts as x = floor(256 * c); a score is the integer inner product of
two vectors.  A row's components are cut into bit-planes, most significant first
(two's complement).  After some planes a score is known up to an interval: what is
left of each component lies in [0, 2**s - 1].  Every further plane halves it, and a
candidate is dropped as soon as its interval can't qualify any more.  While most
candidates live, a plane is one product of 0/1 matrices; later only the living ones
are multiplied.

Rows and anchors are dealt to a grid of (block of rows, block of anchors).  A first
pass finds each anchor's positives (the best of a block, then the best of all
blocks), a second one the negatives below each positive's score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .whitening import STEPS, stepped, usable

#: Rows and anchors of one task, and the least rows that are worth one.
BLOCK_ROWS, BLOCK_ANCHORS, LEAST_ROWS = 16_384, 4_096, 2_048
#: Anchors multiplied at once, and the share of living candidates below which they are multiplied one by one.
AT_ONCE, FEW = 64, 0.125
_NONE = np.iinfo(np.int64).min // 4


def planes(x: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(weight, bits left, 0/1 matrix) from the most significant plane; the sums of weight * plane give ``x`` (64-bit integers)."""
    top = int(max(x.max(initial=0), -x.min(initial=0) - 1, 0)).bit_length()
    bit = lambda s: ((x >> s) & 1).astype(np.float64)
    return [(-(1 << top), top, bit(top))] + [(1 << s, s, bit(s)) for s in range(top - 1, -1, -1)]


class Intervals:
    """Scores of anchors with rows, plane by plane, for the candidates that are still alive."""

    def __init__(self, anchors: np.ndarray, rows: list[tuple[int, int, np.ndarray]], alive: np.ndarray):
        self.anchors, self.rows, self.alive = anchors.astype(np.float64), rows, alive
        self.below, self.above = np.minimum(anchors, 0).sum(axis=1), np.maximum(anchors, 0).sum(axis=1)
        self.dense: np.ndarray | None = np.zeros(alive.shape, np.int64)
        self.at: tuple[np.ndarray, np.ndarray] = (np.empty(0, int), np.empty(0, int))
        self.known = np.empty(0, np.int64)

    def tightened(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, low, high) of all living candidates after each plane; ``keep`` then drops some."""
        for weight, left, plane in self.rows:
            if self.dense is not None and self.alive.mean() > FEW:
                self.dense += np.int64(weight) * (self.anchors @ plane.T).astype(np.int64)
                self.at = np.nonzero(self.alive)
                self.known = self.dense[self.at]
            else:
                if self.dense is not None:
                    self.at = np.nonzero(self.alive)
                    self.known, self.dense = self.dense[self.at], None
                a, r = self.at
                for part in range(0, len(a), 1 << 16):
                    some = slice(part, part + (1 << 16))
                    self.known[some] += np.int64(weight) * np.einsum("nd,nd->n", self.anchors[a[some]], plane[r[some]]).astype(np.int64)
            rest = (1 << left) - 1
            yield *self.at, self.known + rest * self.below[self.at[0]], self.known + rest * self.above[self.at[0]]

    def keep(self, mask: np.ndarray) -> None:
        if self.dense is None:
            self.at, self.known = (self.at[0][mask], self.at[1][mask]), self.known[mask]
        else:
            self.alive[self.at] = mask


def kth_largest(group: np.ndarray, value: np.ndarray, k: int, n: int) -> np.ndarray:
    """For each of ``n`` groups the k-th largest of its values, a very small number where there are fewer."""
    out = np.full(n, _NONE, np.int64)
    order = np.lexsort((-value, group))
    g = group[order]
    at = np.searchsorted(g, np.arange(n)) + k - 1
    there = at < len(g)
    there[there] = g[at[there]] == np.arange(n)[there]
    out[there] = value[order][at[there]]
    return out


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g) < k]


def positives_of(anchors: np.ndarray, alive: np.ndarray, x: list, ids: np.ndarray, k: int):
    """(anchor, row, score) of the k best living candidates of each anchor."""
    scores = Intervals(anchors, x, alive)
    for a, r, low, high in scores.tightened():
        best = kth_largest(a, low, k, len(anchors))
        scores.keep(high >= best[a])
    a, r = scores.at if scores.dense is None else np.nonzero(scores.alive)
    known = scores.known if scores.dense is None else scores.dense[a, r]
    first = _first(a, known, ids[r], k)
    return a[first], r[first], known[first]


def negatives_of(anchors: np.ndarray, alive: np.ndarray, x: list, ids: np.ndarray, tops: np.ndarray, lows: np.ndarray, k: int):
    """(anchor, slot, row, score): for each anchor and slot the k best living candidates with a score in [lows, tops].

    Slots of an anchor that aren't used have a top below their low.
    """
    scores = Intervals(anchors, x, alive)
    slots = tops.shape[1]
    for a, r, low, high in scores.tightened():
        wanted = np.zeros(len(a), bool)
        for p in range(slots):
            lo, hi = lows[a, p], tops[a, p]
            sure = (low >= lo) & (high <= hi)
            best = kth_largest(a[sure], low[sure], k, len(anchors))
            wanted |= (lo <= hi) & (high >= lo) & (low <= hi) & (high >= best[a])
        scores.keep(wanted)
    a, r = scores.at if scores.dense is None else np.nonzero(scores.alive)
    known = scores.known if scores.dense is None else scores.dense[a, r]
    out = []
    for p in range(slots):
        fits = np.nonzero((known >= lows[a, p]) & (known <= tops[a, p]))[0]
        first = fits[_first(a[fits], known[fits], ids[r[fits]], k)]
        out.append((a[first], np.full(len(first), p), r[first], known[first]))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _matrix(column, d: int) -> np.ndarray:
    """Vectors of whole numbers as a matrix whose products fit 64 bits and are exact in doubles."""
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.int64)
    if len(x) and d * int(np.abs(x).max()) ** 2 >= 1 << 61 or len(x) and d * int(np.abs(x).max()) >= 1 << 52:
        raise ValueError("components are too large for exact 64-bit scores")
    return x


def _sorted_block(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, x) of rows in order of their labels, so that a label is a slice."""
    t = t.sort_by("label")
    d = len(t["x"][0])
    return t["id"].to_numpy(), t["label"].to_numpy(), _matrix(t["x"], d)


def _positive_task(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(rows) and len(anchors):
            ids, labels, x = _sorted_block(rows)
            a_ids, a_labels, a_x = _sorted_block(anchors)
            for name in np.unique(a_labels):
                of = slice(*np.searchsorted(labels, [name, name + 1]))
                mine = np.nonzero(a_labels == name)[0]
                if of.start == of.stop:
                    continue
                cut = planes(x[of])
                for part in range(0, len(mine), AT_ONCE):
                    some = mine[part : part + AT_ONCE]
                    alive = a_ids[some][:, None] != ids[of][None]
                    a, r, score = positives_of(a_x[some], alive, cut, ids[of], k)
                    found.append((a_ids[some][a], ids[of][r], score))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(c.astype(np.int64)) for c in cols], names=["anchor_id", "id", "score"])

    return run


def _negative_task(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(rows) and len(anchors):
            ids, labels, x = _sorted_block(rows)
            a_ids, a_labels, a_x = _sorted_block(anchors)
            scores = anchors.sort_by("label")["scores"].to_pylist()
            cut = planes(x)
            for part in range(0, len(a_ids), AT_ONCE):
                some = slice(part, part + AT_ONCE)
                mine = scores[some]
                slots = max(map(len, mine))
                s = np.array([v + [None] * (slots - len(v)) for v in mine], object)
                tops = np.array([[-1 if v is None else high * v // 100 for v in row] for row in s], np.int64).reshape(len(mine), slots)
                lows = np.array([[0 if v is None else -(-low * v // 100) for v in row] for row in s], np.int64).reshape(len(mine), slots)
                alive = a_labels[some][:, None] != labels[None]
                a, p, r, score = negatives_of(a_x[some], alive, cut, ids, tops, lows, k)
                found.append((a_ids[some][a], s[a, p].astype(np.int64), ids[r], score))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c.astype(np.int64)) for c in cols], names=["anchor_id", "positive_score", "id", "score"])

    return run


def _dealt(rows: DataFrame, anchors: DataFrame, nr: int, na: int):
    """Rows and anchors by the block of rows and the block of anchors, each sent to its line or column of the grid."""
    at = lambda n: F.pmod(F.xxhash64("id", F.lit(11)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = rows.withColumn("rb", at(nr)).withColumn("ab", every(na))
    a = anchors.withColumn("ab", at(na)).withColumn("rb", every(nr))
    return r.groupBy("rb", "ab").cogroup(a.groupBy("rb", "ab"))


def _best(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each group, of what the blocks give: rank, higher scores first, then smaller ids."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, steps: int = STEPS,
    block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on ``id_col`` that says which rows are anchors.  An
    anchor's positives are its best rows of its label; a pair's negatives the best rows
    of other labels with low * positive <= 100 * negative <= high * positive.  Higher
    scores come first, ties by smaller id.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component
    take no part.  Rows that share an id are one row: the one with the smallest (label,
    vector).  Labels are integers.  Vectors must have one length (an error otherwise), and
    scores must fit 64 bits (an error otherwise).  Other columns are ignored, whatever their
    names; an empty table gives an empty result.  A positive without negatives has no rows.
    """
    vector = F.col(f"`{vec_col}`")
    base = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        stepped(F.when(usable(vector), vector), steps).alias("x"))
    base = base.where("id is not null and label is not null and x is not null")
    base = base.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).select("id", "row.label", "row.x")
    base = C.stored(base)
    largest = F.max(F.greatest(F.array_max("x"), -F.array_min("x")))
    n, shortest, longest, largest = base.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x")), largest).first()
    if shortest != longest:
        raise ValueError(f"vectors have {shortest} to {longest} entries")
    if n and largest < 1 << 15:  # a quarter of the bytes for all exchanges
        base = base.withColumn("x", F.col("x").cast("array<smallint>"))
    anchors = base.where(anchor(F.col("id")))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nr = max(-(-n // block_rows), min(tasks, n // LEAST_ROWS), 1)
    na = max(-(-anchors.count() // block_anchors), 1)

    near = _dealt(base, anchors, nr, na).applyInArrow(_positive_task(positives), "anchor_id long, id long, score long")
    chosen = C.stored(_best(near, ["anchor_id"], positives).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # Equal scores of an anchor's positives have equal negatives: each distinct score is looked for once.
    scores = chosen.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))
    asking = C.stored(anchors.join(scores, anchors["id"] == scores["anchor_id"]).select("id", "label", "x", "scores"))
    found = _dealt(base, asking, nr, na).applyInArrow(
        _negative_task(negatives, low, high), "anchor_id long, positive_score long, id long, score long")
    found = _best(found, ["anchor_id", "positive_score"], negatives)
    return chosen.join(found, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
