"""Operators on embeddings against brute force, with nulls, repeats, ties, odd vectors and clashing names."""

import math
import random

import numpy as np
import pytest

from skyloom.llm import hard_negatives, vector_dedup, whitening

#: Extra columns have names that the operators use themselves.
SCHEMA = "vec_id long, embedding array<{}>, label int, id string, x int, cell int, root int, n int, u string, component string, rank int, weight int"
ODD = [
    (9001, None, 1), (9002, [0.0] * 6, 1), (9003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (9004, [float("nan")] + [1.0] * 5, 1),
    (9005, [float("inf")] + [1.0] * 5, 1), (9006, [], 1), (9007, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], None), (None, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1),
]


def frame(spark, rows, item="double"):
    return spark.createDataFrame([(i, v, l, "i", 1, 2, 3, 4, "u", "c", 5, 6) for i, v, l in rows], SCHEMA.format(item))


def finite(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def groups(n, seed, d=6, labels=3):
    """Vectors around some centres, of several spreads, with exact copies and other lengths of the same direction."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, d))
    x = centre[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.3, 0.8], size=(n, 1))
    x[n // 2 : n // 2 + 40] = x[3]
    x[-10:] = 7 * x[:10]
    return [(int(i), [float(c) for c in v], int(k)) for i, v, k in zip(rng.permutation(3 * n)[:n], x, rng.integers(0, labels, n), strict=True)]


def linked(rows, cosine):
    """id: (n_links, component) by all pairs."""
    part = [(i, np.array(v), k) for i, v, k in rows if i is not None and k is not None and finite(v) and any(v)]
    links = {i: set() for i, _, _ in rows if i is not None}
    for i, v, k in part:
        for j, w, m in part:
            if i != j and k == m and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= cosine:
                links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = len(links[i]), min(seen)
    return out


@pytest.mark.parametrize("cell_rows, block_rows", [(8, 16), (40, 64), (10_000, 2_048)])
def test_vector_dedup(spark, cell_rows, block_rows):
    rows = groups(420, 1) + ODD
    out = vector_dedup.vector_dedup(frame(spark, rows), 0.93, cell_rows=cell_rows, block_rows=block_rows).collect()
    want = linked(rows, 0.93)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out} == {(i, n, c, i == c) for i, (n, c) in want.items()} | {(None, 0, None, True)}
    assert len(out) == len(rows)
    assert max(n for n, _ in want.values()) > 12


def test_vector_dedup_of_other_lengths(spark):
    rows = groups(60, 2) + [(5000 + i, v[:4], k) for i, (_, v, k) in enumerate(groups(60, 2))]
    out = vector_dedup.vector_dedup(frame(spark, rows, "float"), 0.9, cell_rows=5, block_rows=16).collect()
    single = [(i, [float(np.float32(c)) for c in v], k) for i, v, k in rows]
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == linked(single, 0.9)


def test_vector_dedup_repeated_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)]
    out = sorted(tuple(r) for r in vector_dedup.vector_dedup(frame(spark, rows)).collect())
    assert out == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vector_dedup.vector_dedup(frame(spark, [])).collect() == []
    assert [tuple(r) for r in vector_dedup.vector_dedup(frame(spark, [(4, None, 1)])).collect()] == [(4, 0, 4, True)]


def negatives(rows, positives=5, most=3, low=50, high=95):
    part = {}
    for i, v, k in rows:
        if i is not None and k is not None and finite(v):
            x = [math.floor(256 * c) for c in v]
            part[i] = min(part.get(i, (k, x)), (k, x))
    out = set()
    for a, (k, x) in part.items():
        if a % 10:
            continue
        score = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i) for i, (_, y) in part.items() if i != a)
        for s, p in [(s, i) for s, i in score if part[i][0] == k][:positives]:
            fit = [(t, i) for t, i in score if part[i][0] != k and low * -s <= 100 * -t <= high * -s][:most]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(fit, 1)}
    return out


@pytest.mark.parametrize("block_rows, block_anchors", [(50, 9), (10_000, 10_000)])
def test_hard_negatives(spark, block_rows, block_anchors):
    odd = [r for r in ODD if r[0] != 9002] + [(9010, [0.0] * 6, 1), (20, [0.5] * 6, 0), (20, [0.5] * 6, 0), (20, [0.25] * 6, 0)]
    rows = [r for r in groups(300, 3) if r[0] != 20] + odd + [(9100 + 10 * i, [0.001 * i, -0.002, 0.0, 0.003, -0.001, 0.0], i % 2) for i in range(30)]
    random.Random(1).shuffle(rows)
    out = hard_negatives.hard_negatives(frame(spark, rows), lambda i: i % 10 == 0, block_rows=block_rows, block_anchors=block_anchors)
    got = [tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got)) and set(got) == negatives(rows)
    assert len(got) > 200


def test_hard_negatives_few_rows(spark):
    assert hard_negatives.hard_negatives(frame(spark, []), lambda i: i % 10 == 0).collect() == []
    rows = [(10, [1.0, 0.5], 1), (11, [1.0, 0.4], 1), (12, [0.7, 0.7], 2)]
    got = {tuple(r) for r in hard_negatives.hard_negatives(frame(spark, rows), lambda i: i % 10 == 0).collect()}
    assert got == negatives(rows) == {(10, 11, 1, 12, 256 * 256 + 128 * 102, 256 * 179 + 128 * 179)}
    with pytest.raises(Exception, match="too large"):
        hard_negatives.hard_negatives(frame(spark, [(10, [1e9, 1.0], 1), (11, [1e9, 2.0], 1)]), lambda i: i % 10 == 0).collect()


def test_planes_give_back_the_vectors():
    x = np.random.default_rng(1).integers(-300, 280, (50, 7))
    for some in (x, np.abs(x), np.zeros_like(x), -np.abs(x), x * 10**9):
        assert (sum(np.int64(w) * p.astype(np.int64) for w, _, p in hard_negatives.planes(some)) == some).all()


def test_whitening(spark):
    rows = groups(200, 4) + ODD
    out = whitening.whiten(frame(spark, rows, "float")).collect()
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, _ in rows if finite(v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    values, axes = np.linalg.eigh(np.cov(np.array(fit, float).T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    assert len(out) == 4 * len(kept) and {r.n for r in out} == {n}
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.component), []).append(r)
    sign = {}
    for i, x in kept:
        for c in range(4):
            want = (np.array(x) - np.array(sums) / n) @ axes[:, c] / math.sqrt(values[c])
            for r in by[i, c + 1]:
                assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) or i is None or [k for k, _ in kept].count(i) > 1
                assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
                assert abs(r.identity_error) < 1e-9
                if abs(want) > 1e-6:
                    assert sign.setdefault(c, np.sign(want * r.whitened)) * r.whitened == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_whitening_without_spread(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None, 1)])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1), (None, [0.5, 0.25], 1)])).collect()
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)} and len(one) == 6
    flat = whitening.whiten(frame(spark, [(1, [0.5, 0.25], 1), (2, [1.5, 0.25], 1)])).collect()
    assert {(r.component, r.explained) for r in flat} == {(1, 1.0), (2, 0.0)}
    assert sorted(abs(r.whitened) for r in flat if r.component == 1) == pytest.approx([1, 1]) and all(r.whitened is None for r in flat if r.component == 2)
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(frame(spark, [(1, [0.5], 1), (2, [0.5, 1.0], 1)]))


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [1e13 * i, -1e13], 1) for i in range(5)]
    out = whitening.whiten(frame(spark, rows)).collect()
    x = [[math.floor(256 * c) for c in v] for _, v, _ in rows]
    want = {i: sum((5 * a - sum(c)) ** 2 for a, c in zip(x[i], zip(*x, strict=True), strict=True)) for i in range(5)}
    assert {r.vec_id: int(r.deviation) for r in out} == want
