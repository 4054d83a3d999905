"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

Documents are dealt into blocks of neighbouring ids (splitters are quantiles of
the id).  Each block hashes all its windows and sends every distinct hash once to
the task of its hash range, as packed 64-bit words; that task counts each hash
over the blocks and marks it, a bit each, for all blocks that share it.  So a window
that a third of all documents share reaches a task once a block.  Equal hashes
alone prove nothing at 1e13 windows: the shared ones, a small part of all, go once
more, each with a second hash of its words under another seed and base, and now
every block but the first that holds the pair is answered.  A block then
removes what its answers and its own earlier windows cover, merged into maximal
intervals.  The texts are shuffled once: all uses of the blocks share that exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 20
_BASE = 0x9E3779B97F4A7C15
#: Seed of the words and base of the windows for the second hash.
_SEED2, _BASE2 = 0x5851F42D4C957F2D, 0xD1342543DE82EF95
_U = np.uint64


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words) if not seed else (digest(w, seed) for w in words), _U, len(words))


def window_hashes(h: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """The polynomial hash, modulo 2**64, of each run of ``size`` word hashes.

    Runs double (1, 2, 4, ... words), so a window costs log2(size) steps.
    """
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        out, done, run, width = None, 0, h, 1
        while True:
            if size & width:
                part = run[done : done + n]
                out = part.copy() if out is None else out * _U(pow(base, width, 2**64)) + part
                done += width
            if width * 2 > size:
                break
            run = run[:-width] * _U(pow(base, width, 2**64)) + run[width:]
            width *= 2
        out ^= out >> _U(29)
        return out * _U(0xBF58476D1CE4E5B9)


def _block(table: pa.Table, size: int):
    """The block's documents in order of (id, text), their words and window hashes."""
    ids, texts = table["id"].to_pylist(), table["text"].to_pylist()
    raw = [(t or "").encode() for t in texts]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, raw[i]))
    words = [raw[i].split() for i in order]
    return [ids[i] for i in order], words, [window_hashes(word_hashes(w), size) for w in words]


def _pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte planes of which compress."""
    gaps = np.diff(hashes, prepend=_U(0)).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(planes.T).view(_U).ravel(), dtype=_U)


def _checks(words: list[list[bytes]], windows: list[np.ndarray], wanted: np.ndarray, size: int) -> np.ndarray:
    """The second hashes of the block's windows that ``wanted`` marks, in order."""
    out, end = [], 0
    for w, h in zip(words, windows, strict=True):
        mine = wanted[end : end + len(h)]
        end += len(h)
        if mine.any():
            out.append(window_hashes(word_hashes(w, _SEED2), size, _BASE2)[mine])
    return np.concatenate(out) if out else np.empty(0, _U)


def _held(values: np.ndarray, in_sorted: np.ndarray) -> np.ndarray:
    if not len(in_sorted):
        return np.zeros(len(values), bool)
    return in_sorted[np.minimum(np.searchsorted(in_sorted, values), len(in_sorted) - 1)] == values


def _ranked(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, the order of ``flat``, and the place of each value in that order among the distinct ones.

    By one sort: ``np.unique`` builds a hash table first, and searching unsorted values one by one misses the cache.
    """
    order = np.argsort(flat)
    values = flat[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new], order, np.cumsum(new) - 1


def _distinct(flat: np.ndarray) -> np.ndarray:
    values = np.sort(flat)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def repeated(h: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Marks every pair (hash, second hash) that has an equal one before it."""
    by = np.lexsort((checks, h))  # stable: equal pairs keep their order
    out = np.zeros(len(h), bool)
    out[by[1:]] = (h[by[1:]] == h[by[:-1]]) & (checks[by[1:]] == checks[by[:-1]])
    return out


def _slices(h: np.ndarray, n_ranges: int) -> dict[int, slice]:
    """Where each range of hashes lies in sorted ones."""
    part = ((h >> _U(32)) * _U(n_ranges) >> _U(32)).astype(np.int64)
    which, starts = np.unique(part, return_index=True)
    ends = np.append(starts[1:], len(h))[: len(starts)]
    return {int(r): slice(int(a), int(b)) for r, a, b in zip(which, starts, ends, strict=True)}


def _bits(mask: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(mask).tobytes())


def _marks(n: int, slices: dict[int, slice], answers: pa.Table, name: str) -> np.ndarray:
    """The answers of all ranges as one mask over the ``n`` sorted hashes that the block sent."""
    out = np.zeros(n, bool)
    for r, blob in zip(answers["range"].to_pylist(), answers[name], strict=True):
        at = slices[r]
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), np.uint8)
        out[at] = np.unpackbits(raw, count=at.stop - at.start)
    return out


def _send(size: int, n_ranges: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, _, windows = _block(table, size)
        h = _distinct(np.concatenate(windows)) if windows else np.empty(0, _U)
        slices = _slices(h, n_ranges)
        return pa.table({
            "range": pa.array(list(slices), pa.int32()), "block": pa.array([key[0].as_py()] * len(slices), pa.int32()),
            "hashes": pa.array([_pack(h[at]) for at in slices.values()], pa.binary())})

    return run


def _in_order(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """A range's messages by block, and their hashes."""
    table = table.sort_by("block")
    return table, [_unpack(x.as_py()) for x in table["hashes"]]


def _answered(table: pa.Table, masks: list[np.ndarray], name: str, *columns: str) -> pa.Table:
    """The rows of ``table`` whose mask marks something, with it."""
    some = pa.array([bool(m.any()) for m in masks], pa.bool_())
    bits = pa.array([_bits(m) if m.any() else None for m in masks], pa.binary())
    return table.select(["block", "range", *columns]).append_column(name, bits).filter(some)


def _share(key: tuple, table: pa.Table) -> pa.Table:
    """Marks, for each block, the hashes of this range that another block sent too."""
    table, lists = _in_order(table)
    flat = np.sort(np.concatenate(lists))
    shared = flat[1:][flat[1:] == flat[:-1]]  # each block sends a hash once
    return _answered(table, [_held(x, shared) for x in lists], "shared")


def _pairs(h: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (hash, second hash), sorted."""
    by = np.lexsort((checks, h))
    by = by[~repeated(h[by], checks[by])]
    return h[by], checks[by]


def _shared(flat: np.ndarray, answers: pa.Table, n_ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks the block's windows whose hashes other blocks sent too, and those whose hashes the block has more than once."""
    h, order, rank = _ranked(flat)
    elsewhere, here = np.zeros(len(flat), bool), np.zeros(len(flat), bool)
    elsewhere[order] = _marks(len(h), _slices(h, n_ranges), answers, "shared")[rank]
    here[order] = (np.bincount(rank, minlength=len(h)) > 1)[rank]
    return elsewhere, here


def _resend(size: int, n_ranges: int):
    """The block's pairs of shared hashes, with the marks that it got: the answer brings these back."""
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        _, words, windows = _block(docs, size)
        flat = np.concatenate(windows) if windows else np.empty(0, _U)
        wanted, _ = _shared(flat, answers, n_ranges)
        h, checks = _pairs(flat[wanted], _checks(words, windows, wanted, size))
        slices = _slices(h, n_ranges)
        sent = [slices[r] for r in answers["range"].to_pylist()]
        return pa.table({
            "range": answers["range"], "block": pa.array([key[0].as_py()] * len(sent), pa.int32()),
            "hashes": pa.array([_pack(h[at]) for at in sent], pa.binary()),
            "checks": pa.array([checks[at].tobytes() for at in sent], pa.binary()), "shared": answers["shared"]})

    return run


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """Marks, for each block, the pairs of this range that an earlier block sent too."""
    table, lists = _in_order(table)
    checks = [np.frombuffer(x.as_py(), _U) for x in table["checks"]]
    again = repeated(np.concatenate(lists), np.concatenate(checks))
    return _answered(table, np.split(again, np.cumsum([len(x) for x in lists])[:-1]), "again", "shared")


def covered(starts: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Words that the windows at ``starts`` cover; overlapping windows merge into maximal intervals."""
    edge = np.zeros(n_words + 1, np.int32)
    edge[starts] += 1
    edge[starts + size] -= 1
    return np.cumsum(edge[:-1]) > 0


def _remove(size: int, n_ranges: int):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, words, windows = _block(docs, size)
        flat = np.concatenate(windows) if windows else np.empty(0, _U)
        elsewhere, here = _shared(flat, answers, n_ranges)
        maybe = elsewhere | here
        mine, sent = _checks(words, windows, maybe, size), elsewhere[maybe]
        h, checks = _pairs(flat[maybe][sent], mine[sent])
        earlier = _marks(len(h), _slices(h, n_ranges), answers, "again")
        # pairs of earlier blocks stand before the block's own windows, so whatever equals one is a repetition
        pairs = repeated(np.concatenate([h[earlier], flat[maybe]]), np.concatenate([checks[earlier], mine]))
        again = np.zeros(len(flat), bool)
        again[maybe] = pairs[int(earlier.sum()) :]
        n_removed, texts, spans, end = [], [], [], 0
        for w, h in zip(words, windows, strict=True):
            starts = np.flatnonzero(again[end : end + len(h)])
            end += len(h)
            mask = covered(starts, len(w), size) if len(starts) else np.zeros(len(w), bool)
            n_removed.append(int(mask.sum()))
            edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
            spans.append(edges.reshape(-1, 2).tolist())
            texts.append(b" ".join([x for x, gone in zip(w, mask.tolist(), strict=True) if not gone] if n_removed[-1] else w))
        return pa.table({
            "id": pa.array(ids, pa.int64()), "n_words": pa.array([len(w) for w in words], pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "removed": pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            "kept_text": pa.array(texts, pa.binary()),
        })

    return run


def _longs(values: list[int]) -> Column:
    """An array column of the values: one literal, which the optimizer folds, however many they are."""
    text = F.split(F.lit(",".join(map(str, values))), ",") if values else F.array()
    return text.cast("array<bigint>")


def with_block(rows: DataFrame, n_blocks: int) -> DataFrame:
    """``rows`` (id, ...) with block int: neighbouring ids share one; null ids come last."""
    cuts = rows.approxQuantile("id", [i / n_blocks for i in range(1, n_blocks)], 1 / (4 * n_blocks)) if n_blocks > 1 else []
    cuts = sorted({int(c) for c in cuts})
    step = max(1, int(len(cuts) ** 0.5))
    coarse, fine = _longs(cuts[step - 1 :: step]), _longs(cuts)
    below = lambda a, x: F.size(F.filter(a, lambda c: c <= x))
    major = rows.withColumn("_major", F.when(F.col("id").isNotNull(), below(coarse, F.col("id"))))
    at = F.col("_major") * step
    block = at + below(F.slice(fine, at + 1, F.lit(step)), F.col("id"))
    return major.withColumn("block", F.coalesce(block, F.lit(len(cuts))).cast("int")).drop("_major")


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, removed, kept_text (binary, UTF-8).

    A window goes where its words also start earlier: in a smaller id, or earlier
    in the same document.  ``removed`` has maximal [start, end) word intervals.
    Null texts have no words; null ids come after all others; rows that share an
    id count as parts of one document, in the order of their texts.  Other columns are
    ignored, whatever their names; an empty table gives an empty result; a text is
    windowed whole, whatever its length.
    """
    n_blocks = C.n_tasks(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # approxQuantile reads the ids alone, and its sketch is bounded by the number of blocks.
    blocks = with_block(rows, n_blocks).repartition(n_blocks, "block")
    sent = blocks.groupBy("block").applyInArrow(_send(size, n_blocks), "range int, block int, hashes binary")
    shared = sent.groupBy("range").applyInArrow(_share, "block int, range int, shared binary")
    again = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _resend(size, n_blocks), "range int, block int, hashes binary, checks binary, shared binary")
    answers = again.groupBy("range").applyInArrow(_count, "block int, range int, shared binary, again binary")
    return (
        blocks.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_remove(size, n_blocks), "id long, n_words long, n_removed long, removed array<array<int>>, kept_text binary")
        .withColumnRenamed("id", id_col)
    )
