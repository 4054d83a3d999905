"""Near-dedup by fast similarity sketches, banding and exact verification.

Sketch (rounds of hashed bin placement): in round i each element of the set gets
a random bin and a random value, ranked below all values of later rounds; in
rounds 0..t-1 the bin is random, in rounds t..2t-1 it is bin i - t for all
elements.  Each bin keeps its least value, and rounds go on until every bin is
filled, so each coordinate fills within 2t rounds and a round on large sets
costs one hash an element instead of t.

The links are exact for the sets: documents with equal sets form a class and
class representatives go on; band buckets propose pairs; every pair is verified
on the full sets, read from the texts again.  Within a bucket nobody emits all
pairs: each member is compared with a pivot, verified links are merged into
components, and members of buckets that still span several components are
compared with another pivot.  What then is open is settled exactly by prefixes of
the sets in order of rarity: two sets of the wanted similarity share an element
near the front of both, and copies with many changes have nothing there but their
own changes.  Pairs within a component are never formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .components import merged

BINS = 160
ROWS = 4
PIVOT_ROUNDS = 2
_U = np.uint64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over seeded values."""
    x = (x ^ _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1)))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text, A-Z lower-cased.

    Fewer than k words make one shingle; no words make none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    if len(h) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], _U)
    out = h[: len(h) - k + 1].copy()
    with np.errstate(over="ignore"):
        for j in range(1, k):
            out = out * _U(0x9E3779B97F4A7C15) + _mix(h[j : len(h) - k + 1 + j], j)
        return np.unique(_mix(out, 7))


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` 64-bit values (round, value) for each non-empty set."""
    n = len(sets)
    out = np.full(n * bins, ~_U(0), _U)
    if not n:
        return out.reshape(0, bins)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    with np.errstate(over="ignore"):
        for i in range(2 * bins):
            x = _mix(flat, 100 + i)
            place = ((x >> _U(40)) * _U(bins) >> _U(24)).astype(np.int64) if i < bins else i - bins
            value = (x & _U(0xFFFFFFFFFF)) | (_U(i) << _U(40))
            np.minimum.at(out, owner * bins + place, value)
            open_ = (out.reshape(n, bins) == ~_U(0)).any(axis=1)
            if not open_.any():
                break
            if not open_.all():
                keep = open_[owner]
                flat, owner = flat[keep], owner[keep]
    return out.reshape(n, bins)


def _batches(sets: list[np.ndarray], most: int = 1 << 18) -> Iterator[slice]:
    start = total = 0
    for i, s in enumerate(sets):
        if total + len(s) > most and i > start:
            yield slice(start, i)
            start, total = i, 0
        total += len(s)
    if start < len(sets):
        yield slice(start, len(sets))


def _fingerprint(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, sizes = [], []
            for t in b["text"]:
                s = shingle_set(t.as_py(), k)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            yield pa.record_batch(
                [b["id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                names=["id", "n_shingles", "digest"])

    return run


def _bands(k: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), k) for t in b["text"]]
            ids = b["id"].to_numpy(zero_copy_only=False)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            for part in _batches(sets):
                sk = sketches(sets[part], bins)
                n, width = len(sk), bins // rows
                key = np.zeros((n, width), _U)
                with np.errstate(over="ignore"):
                    for j in range(rows):
                        key = _mix(key * _U(0x9E3779B97F4A7C15) + sk[:, j::rows][:, :width], j)
                    key = _mix(key + np.arange(width, dtype=_U) * _U(0xD6E8FEB86659FD93), 50)
                yield pa.record_batch(
                    [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids[part], width), pa.int64()),
                     pa.array(np.repeat(sizes[part], width), pa.int64())], names=["key", "id", "n"])

    return run


def _elements(k: int):
    """(id, element) for each shingle of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b["id"].to_pylist(), b["text"].to_pylist(), strict=True):
                s = shingle_set(t, k)
                yield pa.record_batch([pa.array(np.full(len(s), i)), pa.array(s.view(np.int64))], names=["id", "e"])

    return run


def _prefix_pairs(texts: DataFrame, open_: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, n, m): all pairs of open documents (id, label) of two components that may reach the similarity.

    Elements are ordered by (number of sets that hold them, value).  If sets of n and
    m elements reach it, they share ``percent * (n + m) / (100 + percent)`` elements,
    so at their first shared one, at places i and j, n - i and m - j are no less.
    Elements that a single component holds are left out, and of the others the
    largest component is only compared with the rest.
    """
    e = C.stored(texts.join(open_.select("id"), "id", "left_semi").mapInArrow(_elements(k), "id long, e long"))
    held = C.stored(e.groupBy("e").agg(F.count("*").alias("df")))
    ordered = e.join(held, "e").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("es"))
    n = F.size("es")
    ordered = ordered.select("id", n.alias("n"), F.posexplode(F.slice("es", F.lit(1), n - F.ceil(n * percent / 100).cast("int") + 1)).alias("i", "s"))
    front = C.stored(ordered.where("s.df > 1").select("id", "n", "i", F.col("s.e").alias("e")).join(open_, "id"))
    sizes = front.groupBy("e", "label").agg(F.count("*").alias("c"))
    mixed = C.stored(
        sizes.groupBy("e").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("c", "label")).alias("major")).where("labels > 1"))
    left = front.join(mixed.select("e", "major"), "e").where("label != major").select(
        "e", F.col("id").alias("id2"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("label").alias("label2"))
    near = f"least(n - i, m - j) * {100 + percent} >= {percent} * (n + m)"
    return left.join(front, "e").where("label != label2").where(near).select(
        F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), "n", "m")


def _verify(k: int, percent: int):
    """Keeps pairs whose sets reach the similarity; the last left set is kept, as pairs come sorted by it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for b in batches:
            keep = []
            for x, s, t in zip(b["a"].to_pylist(), b["text_a"], b["text_b"], strict=True):
                if left is None or x != last:
                    last, left = x, shingle_set(s.as_py(), k)
                right = shingle_set(t.as_py(), k)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80,
    bins: int = BINS, rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, n_links.

    Texts without words (null, blank) link with nothing: they are their own
    component.  Rows that share an id count as one document.  Rows with a null id
    join the component of an equal set that has an id; without one, component_id
    is null and the row is kept.  n_links counts the verified links of the row's
    class representative.  Other columns are ignored, whatever their names; an empty
    table gives an empty result; whole texts are shingled.  At similarity s a pair shares no band with probability
    (1 - s**rows)**(bins / rows): 7e-10 at 0.8 and the defaults.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = C.stored(base.mapInArrow(_fingerprint(k), "id long, n_shingles long, digest binary"))
    classes = C.stored(
        prints.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    )
    spent: list[str] = []  # tables that the result doesn't read
    with C.noted(spent):
        labels, links = _linked(base, classes, C.n_tasks(docs), k, percent, bins, rows)
    if labels is not None:
        labels, links = C.stored(labels), C.stored(links)
    C.delete(docs.sparkSession, spent)
    return _result(prints, classes, labels, links, id_col)


def _linked(base: DataFrame, classes: DataFrame, n: int, k: int, percent: int, bins: int, rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(id, label) and the verified links (a, b) of the class representatives; None where no two link."""
    reps = classes.where("rep is not null").select(F.col("rep").alias("id")).distinct()
    rep_texts = base.where("id is not null").join(reps, "id", "left_semi")
    rep_texts = C.stored(rep_texts.repartition(n, "id").dropDuplicates(["id", "text"]))
    bands = C.stored(
        rep_texts.mapInArrow(_bands(k, bins, rows), "key long, id long, n long").where("n > 0")
    )
    shared = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    bands = C.stored(bands.join(shared, "key", "left_semi"))

    links = labels = None
    for step in range(PIVOT_ROUNDS + 1):
        if labels is None:
            members = bands.withColumn("label", F.col("id"))
        else:
            members = C.stored(bands.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")))
        pivot = F.min_by(F.struct("id", "n", "label"), F.xxhash64("id", F.lit(step)))
        spread = (
            members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), pivot.alias("p"))
            .where("lo < hi")
        )
        if step < PIVOT_ROUNDS:
            pairs = members.join(spread, "key").where("label != p.label").select(
                F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b"), "n", F.col("p.n").alias("m"))
        else:
            open_ = C.stored(members.join(spread, "key", "left_semi").select("id", "label").distinct())
            pairs = _prefix_pairs(rep_texts, open_, k, percent)
        pairs = C.stored(
            pairs.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").select("a", "b").distinct())
        left = rep_texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = rep_texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        found = C.stored(
            pairs.join(right, "b").join(left, "a").sortWithinPartitions("a")
            .mapInArrow(_verify(k, percent), "a long, b long")
        )
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = merged(labels, found)
    return labels, links


def _result(prints, classes, labels, links, id_col) -> DataFrame:
    if labels is None:
        named = classes.select("digest", F.col("rep").alias("component"), F.lit(0).cast("long").alias("n_links"))
    else:
        degree = (
            links.select("a").unionAll(links.select("b")).groupBy("a").agg(F.count("*").alias("n_links"))
        )
        named = (
            classes.join(labels, classes["rep"] == labels["id"], "left").drop("id")
            .join(degree, F.col("rep") == F.col("a"), "left")
            .select("digest", F.coalesce("label", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
        )
    return prints.join(named, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.when(F.col("digest").isNull(), F.lit(True)).otherwise(F.col("component").eqNullSafe(F.col("id"))).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
