"""Near-dedup of embeddings: spherical k-means cells, blocked cosine products within them.

Cells don't lose links.  Let theta be the angle of the wanted cosine, and c, d the
centroids of two linked vectors' cells.  Their distances from the plane between c and
d add up to no more than the longest chord of theta, so one of the two lies within half
of it; a vector visits all cells that it is so near to.  A pair therefore meets in the
home of at least one of the two, and where it meets in both, it counts in the cell
with the smaller number only.

Groups of copies are the hot keys.  Equal vectors are one vector with a weight.  The
vectors within theta / 2 of their centroid are its core: all of them are linked with each
other, which is counted, not multiplied, and they are one node of the graph.  A vector
further than 3 / 2 theta from the centroid meets none of the core.  What must be multiplied
is cut into blocks where a cell is large, and pairs of blocks are dealt to tasks.  Pairs
never leave a task: it gives each vector its number of links and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components
from .whitening import usable

#: Rows that k-means is fitted on at most, rounds, rows wanted of a label in a cell, most cells, bytes of all centroids.
FIT_ROWS, ROUNDS, CELL_ROWS, MOST_CELLS, CENTROID_BYTES = 100_000, 5, 512, 8_192, 64 << 20
#: Rows and bytes of one block of a cell, at most.
BLOCK_ROWS, BLOCK_BYTES = 2_048, 32 << 20
#: For rounding, where leaving a vector out would lose a link.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; no row is zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(vectors: DataFrame, n: int, k: int, theta: float, fit_rows: int) -> np.ndarray:
    """Unit centroids of spherical k-means over ``vectors`` (id, vec), k at most.

    Centroids within theta / 2 of a larger cell's are merged with it, so that a group of
    copies has one.
    """
    if k < 2:
        return np.empty((0, 0))
    if n > fit_rows:
        vectors = vectors.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < int(fit_rows / n * (1 << 20)))
    largest = F.array_max(F.transform("vec", F.abs)).cast("double")
    v = array_to_vector(F.transform("vec", lambda c: c.cast("double") / largest)).alias("v")
    model = KMeans(k=k, maxIter=ROUNDS, seed=7, distanceMeasure="cosine", featuresCol="v").fit(vectors.select(v))
    weight, c = np.maximum(np.array(model.summary.clusterSizes, float), 1), np.array(list(model.clusterCenters()))
    some = np.linalg.norm(c, axis=1) > 1e-9
    c, weight = unit(c[some]), weight[some]
    out, open_ = [], np.ones(len(c), bool)
    for i in np.argsort(-weight, kind="stable"):
        if open_[i]:
            near = open_ & (c @ c[i] >= np.cos(theta / 2))
            out.append((c[near] * weight[near, None]).sum(axis=0))
            open_ &= ~near
    return unit(np.array(out)) if len(out) > 1 else np.empty((0, 0))


def _matrix(column) -> np.ndarray:
    """Unit rows of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1))


_PLACE = "id long, weight long, label string, dim int, cell int, home int, angle double, visits array<int>, vec array<{}>"


def _places(centres: np.ndarray, theta: float):
    """Each vector in every cell that it lives in or visits, with its angle to the centroid, and at home the cells that it visits.

    Without centroids there is one cell, whose centroid is far from everything.
    """
    reach = np.sqrt(2 - 2 * np.cos(theta)) / 2 + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0)) if len(centres) else None
        for whole in batches:
            for start in range(0, whole.num_rows, size := max((1 << 22) // max(len(centres), 1), 1)):
                b = whole.slice(start, size)
                rows = np.arange(b.num_rows)
                if len(centres):
                    cos = _matrix(b["vec"]) @ centres.T
                    home = cos.argmax(axis=1)
                    row, cell = np.nonzero((cos[rows, home][:, None] - cos <= reach * apart[home]) | (np.arange(len(centres)) == home[:, None]))
                    angle = np.arccos(np.clip(cos[row, cell], -1, 1))
                else:
                    home = cell = np.zeros(b.num_rows, int)
                    row, angle = rows, np.full(b.num_rows, np.pi)
                ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
                visits = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell.astype(np.int32)))
                at = pa.array(row)
                yield pa.record_batch(
                    [*[b[c].take(at) for c in ("id", "weight", "label", "dim")], pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)),
                     pa.array(angle), visits.take(pa.array(row, mask=cell != home[row])), b["vec"].take(at)],
                    names=["id", "weight", "label", "dim", "cell", "home", "angle", "visits", "vec"])

    return run


def forest(adjacent: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of a bipartite adjacency matrix that have links."""
    most = np.iinfo(np.int64).max
    a, b = left, right
    some_a, some_b = adjacent.any(axis=1), adjacent.any(axis=0)
    adjacent = adjacent[some_a][:, some_b]
    left, right = a, b = left[some_a], right[some_b]
    while True:
        new_a = np.minimum(a, np.where(adjacent, b[None], most).min(axis=1))
        new_b = np.minimum(b, np.where(adjacent, new_a[:, None], most).min(axis=0))
        if (new_a == a).all() and (new_b == b).all():
            return np.concatenate([left, right]), np.concatenate([a, b])
        a, b = new_a, new_b


def _compare(cosine: float):
    """Links of a pair of blocks of one cell: (id, n) for rows with links, (a, b) for a forest of them."""
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids, root, weight, home = (t[c].to_numpy() for c in ("id", "root", "weight", "home"))
        cell, b1, b2, to_core = (t[c][0].as_py() for c in ("cell", "b1", "b2", "to_core"))
        u, visits, block = _matrix(t["vec"].chunk(0)), t["visits"].chunk(0), t["block"].to_numpy()
        lives = home == cell
        if to_core:
            core = t["core"].to_numpy(zero_copy_only=False)
            sides = [(core, ~core)]
        elif b1 == b2:
            sides = [(lives, np.ones(len(ids), bool))]
        else:
            sides = [((block == b1) & lives, block == b2), ((block == b2) & lives, (block == b1) & ~lives)]
        counts, edges = np.zeros(len(ids), np.int64), []
        for residents, others in sides:
            h, o = np.nonzero(residents)[0], np.nonzero(others)[0]
            if not len(h) or not len(o):
                continue
            adjacent = u[h] @ u[o].T >= cosine
            adjacent &= ids[h][:, None] != ids[o][None]
            # Where the resident visits the other's home as well, the pair counts in the cell with the smaller number.
            strange = np.unique(home[o][home[o] < cell])
            if len(strange) and adjacent.any():
                mine = visits.take(pa.array(h))
                owner, goes = np.repeat(np.arange(len(h)), mine.value_lengths().to_numpy(zero_copy_only=False)), mine.flatten().to_numpy()
                at = np.minimum(np.searchsorted(strange, goes), len(strange) - 1)
                both = np.zeros((len(h), len(strange)), bool)
                both[owner[strange[at] == goes], at[strange[at] == goes]] = True
                foreign = np.nonzero(home[o] < cell)[0]
                adjacent[:, foreign] &= ~both[:, np.searchsorted(strange, home[o][foreign])]
            if not adjacent.any():
                continue
            counts[h] += adjacent @ weight[o]
            # Two residents of one block meet from either side.
            once = ~lives[o] if b1 == b2 and not to_core else np.ones(len(o), bool)
            counts[o[once]] += adjacent[:, once].T @ weight[h]
            edges.append(forest(adjacent, root[h], root[o]))
        a, b = [np.concatenate(c) for c in zip(*edges, strict=True)] if edges else [np.empty(0, np.int64)] * 2
        a, b = a[a != b], b[a != b]
        some = np.nonzero(counts)[0]
        n, m = len(some), len(a)
        first = np.arange(n + m) < n
        return pa.table({
            "id": np.concatenate([ids[some], a]), "b": pa.array(np.concatenate([ids[some], b]), mask=first),
            "n": pa.array(np.concatenate([counts[some], np.zeros(m, np.int64)]), mask=~first)})

    return run


def _blocks(rows: DataFrame, place: list[str], block_rows: int) -> DataFrame:
    """``rows`` with a block number and ``blocks``, the number of blocks of their place."""
    large = rows.groupBy(*place).agg(F.count("*").alias("_n")).where(F.col("_n") > block_rows)
    blocks = F.coalesce(F.ceil(F.col("_n") / block_rows), F.lit(1)).cast("int")
    return rows.join(large, place, "left").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks").cast("int")).drop("_n")


def _linked(classes: DataFrame, cosine: float, k: int, n: int, block_rows: int, fit_rows: int) -> tuple[DataFrame, DataFrame]:
    """(links, cores): (id, b, n) as the tasks give them; (id, root, n) for the vectors in the core of a cell."""
    theta = float(np.arccos(cosine))
    item = classes.schema["vec"].dataType.elementType.simpleString()
    centres = centroids(classes, n, k, theta, fit_rows)
    placed = C.stored(classes.select("id", "weight", "label", "dim", "vec").mapInArrow(_places(centres, theta), _PLACE.format(item)))
    place = ["label", "dim", "cell"]
    placed = placed.withColumn("core", (F.col("home") == F.col("cell")) & (F.col("angle") <= theta / 2 - SLACK))
    core = placed.where("core")
    rooted = core.groupBy(*place).agg(F.min("id").alias("root"), F.sum("weight").alias("all"))
    core = C.stored(core.join(rooted, place))
    rest = placed.where("not core").withColumn("root", F.col("id"))
    near = rest.where(F.col("angle") <= 1.5 * theta + SLACK)

    shared = [*place, "id", "root", "weight", "home", "core", "visits", "vec", "block", "to_core"]
    among = _blocks(rest, place, block_rows).withColumn("to_core", F.lit(False)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    among = among.select(*shared, F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    # Rows of a core and what is near to it: a grid of their blocks.
    near = _blocks(near.join(core.select(*place).distinct(), place, "left_semi"), place, block_rows)
    met = _blocks(core.join(near.select(*place).distinct(), place, "left_semi"), place, block_rows)
    count = lambda df, name: df.groupBy(*place).agg(F.max("blocks").alias(name))
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    left = met.join(count(near, "across"), place).withColumn("to_core", F.lit(True)).withColumn("b2", every("across")).withColumn("b1", F.col("block"))
    right = near.join(count(met, "across"), place).withColumn("to_core", F.lit(True)).withColumn("b1", every("across")).withColumn("b2", F.col("block"))
    tasks = among.unionByName(left.select(*among.columns)).unionByName(right.select(*among.columns))
    links = C.stored(tasks.groupBy(*place, "to_core", "b1", "b2").applyInArrow(_compare(cosine), "id long, b long, n long"))
    return links, core.select("id", "root", (F.col("all") - F.col("weight")).alias("n"))


def vector_dedup(
    rows: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``rows``: id, n_links, component_id, kept.

    Vectors are compared where their labels are equal and not null, and linked if the
    cosine, in double precision, is ``cosine`` or more (above 0).  All such pairs are found.
    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing, and neither do vectors of different length.  Rows without an id link with
    nothing; their component_id is null and they are kept.  Rows that share an id count as
    one vector, which has the links of all of them.  Other columns are ignored, whatever
    their names; an empty table gives an empty result.  k-means is fitted on about
    ``fit_rows`` rows at most; the result doesn't depend on its cells.
    """
    vector, id_ = F.col(f"`{vec_col}`"), F.col(f"`{id_col}`").cast("long")
    label = F.col(f"`{label_col}`").cast("string")
    takes_part = usable(vector) & F.exists(vector, lambda c: c != 0) & id_.isNotNull() & label.isNotNull()
    whole = rows.select(id_.alias("id"), label.alias("label"), F.when(takes_part, vector).alias("vec"))
    base = whole.withColumn("class", F.when(F.col("vec").isNotNull(), F.sha2(F.concat_ws(" ", "label", F.col("vec").cast("string")), 256)))
    base = C.stored(base)
    classes = base.where("class is not null").groupBy("class").agg(
        F.min("id").alias("id"), F.count_distinct("id").alias("weight"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    spent: list[str] = []
    classes = C.stored(classes.withColumn("dim", F.size("vec")))
    of_label = classes.groupBy("label").agg(F.count("*").alias("n"), F.min("dim").alias("low"), F.max("dim").alias("high"))
    n, largest, low, high = of_label.agg(F.sum("n"), F.max("n"), F.min("low"), F.max("high")).first()
    if not n:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if low != high:  # zeros change no product
        filled = F.array_repeat(F.lit(0).cast(classes.schema["vec"].dataType.elementType), high - F.col("dim"))
        classes = classes.withColumn("vec", F.concat("vec", filled))
    k = min(largest // cell_rows, MOST_CELLS, CENTROID_BYTES // (8 * high))
    with C.noted(spent):
        links, cores = _linked(classes, cosine, k, n, min(block_rows, max(BLOCK_BYTES // (8 * high), 16)), fit_rows)
        edges = links.where("b is not null").select(F.col("id").alias("a"), "b").distinct()
        labels = components(edges)
        sums = links.where("n is not null").select("id", "n").unionByName(cores.select("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
        named = (
            classes.select("class", "id", "weight").join(sums, "id", "left").join(cores.groupBy("id").agg(F.min("root").alias("root")), "id", "left")
            .withColumn("node", F.coalesce("root", "id")).join(labels.select(F.col("id").alias("node"), F.col("label").alias("found")), "node", "left")
            .select("class", F.coalesce("found", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    named = C.stored(named)
    C.delete(rows.sparkSession, spent)
    return base.select("id", "class").join(named, "class", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))
