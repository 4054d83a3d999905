"""Operators on small fixtures: edge cases that the tables don't hold."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import kernels as K
from skyloom.functions import paths as P
from skyloom.functions import scalars as S
from skyloom.operators import assets as A
from skyloom.operators import boxes as B
from skyloom.operators import graph as G
from skyloom.operators import raster as R
from skyloom.sources import images as I
from skyloom.sources import records as J
from skyloom.sources import workflows as W
from skyloom.streaming import events as E


def col(df, *names):
    return sorted(tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect())


def test_paths(spark):
    df = spark.createDataFrame([("a/b.tar.gz",), (".jpg",), ("x/.jpg",), ("noext",), ("d.e/f",)], "p string")
    p = F.col("p")
    rows = df.select(P.stem(p).alias("s"), P.suffix(p).alias("x"), P.parent(p).alias("d")).collect()
    assert [tuple(r) for r in rows] == [("b.tar", ".gz", "a"), (".jpg", "", ""), (".jpg", "", "x"), ("noext", "", ""), ("f", "", "d.e")]


def test_path_order(spark):
    df = spark.createDataFrame([("a-b/c",), ("a/b",)], "p string").orderBy(P.sort_key(F.col("p")))
    assert [r.p for r in df.collect()] == ["a/b", "a-b/c"]


def test_contiguous_split(spark):
    for n, k, sizes in ((11, 4, [3, 3, 3, 2]), (2, 4, [1, 1])):
        df = A.ranked(spark.range(n), F.col("id")).withColumn("s", A.contiguous(k))
        assert [r["count"] for r in df.groupBy("s").count().orderBy("s").collect()] == sizes


def test_renamed_takes_no_name_twice(spark):
    rows = [("a.JPG", "a", ".JPG", 0), ("a.jpg", "a", ".jpg", 0), ("a__dup001.jpg", "a__dup001", ".jpg", 0), ("a.jpg", "a", ".jpg", 1)]
    out = A.renamed(spark.createDataFrame(rows, "rel_path string, stem string, suffix string, shard int")).collect()
    names = [(r.shard, r.dst_name) for r in out]
    assert len(set(names)) == 4 and (0, "a.jpg") in names and (1, "a.jpg") in names


def test_resolve_masks(spark):
    images = spark.createDataFrame([("d/a.jpg", "d", "a"), ("d/b.jpg", "d", "b"), ("d/c.jpg", "d", "c"), ("d/e.jpg", "d", "e")], "rel_path string, parent string, stem string")
    masks = spark.createDataFrame([("d/a.png",), ("a.png",), ("b.png",), ("x/c.png",), ("x/e.png",), ("y/e.png",)], "rel_path string")
    out = {r.rel_path: r["mask"] for r in A.resolve_masks(images, masks).collect()}
    assert out == {"d/a.jpg": "d/a.png", "d/b.jpg": "b.png", "d/c.jpg": "x/c.png", "d/e.jpg": None}


def test_pairs_and_scalars(spark):
    df = spark.createDataFrame([("k=",), ("k=a=b",), ("none",)], "s string")
    k, v = S.split_pair(F.col("s"))
    assert [tuple(r) for r in df.select(k, v).collect()] == [("k", ""), ("k", "a=b"), (None, None)]
    df = spark.createDataFrame([("TRUE",), ("null",), ("0",), ("1_000",), ("1e3",), ("nan",), ("0,1",), ("5d",)], "s string")
    kinds = [r[0] for r in df.select(S.scalar_type(F.col("s"))).collect()]
    assert kinds == ["bool", "null", "int", "int", "float", "float", "str", "str"]


def test_box_rounding(spark):
    box = spark.createDataFrame([(-3.5, 2.5, 1e6, 7.5), (5.0, 5.0, 5.2, 9.0)], "x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r) for r in B.clipped(box, 10, 10, True).collect()] == [(0, 2, 10, 8)]
    assert [tuple(r) for r in B.clipped(box, 10, 10, False).collect()] == [(0, 2, 10, 7)]


def test_tile_windows(spark):
    d = spark.createDataFrame([(2000, 1000)], "w int, h int")
    cut = lambda *a: [tuple(r)[3:] for r in B.tile_windows(d, *a).orderBy("i").collect()]
    assert cut(1, 2, 0.0, 30) == [(0, 0, 1030, 1000), (970, 0, 2000, 1000)]
    wide = spark.createDataFrame([(3000, 1000)], "w int, h int")
    xs = [(r.x1, r.x2) for r in B.tile_windows(wide, 1, 3, 0.0, 30).orderBy("i").collect()]
    assert xs == [(0, 1030), (970, 2000), (1970, 3000)]


def as_relation(spark, a):
    return spark.createDataFrame([(0, y, x, float(a[y, x])) for y in range(a.shape[0]) for x in range(a.shape[1])], "img long, y int, x int, v double")


def as_array(df, h, w):
    out = np.full((h, w), np.nan)
    for r in df.collect():
        out[r.y, r.x] = r.v
    return out


def test_kernels_equal_relations(spark):
    a = np.random.default_rng(3).random((7, 6))
    px = as_relation(spark, a)
    k = R.kernel_of_radius(2)
    assert np.allclose(as_array(R.blurred(px, k, 7, 6), 7, 6), K.convolve(a, k), atol=1e-12)
    assert np.array_equal(as_array(R.dilated(px, 2), 7, 6), K.extreme(a, 2))
    assert np.array_equal(as_array(R.eroded(px, 1), 7, 6), K.extreme(a, 1, np.minimum))


def test_each_raster(spark):
    a = np.random.default_rng(4).random((5, 5))
    df = spark.createDataFrame([(1, 5, 5, bytearray(a.tobytes()))], "img long, h int, w int, data binary")
    out = df.mapInArrow(K.each_raster(lambda x: K.extreme(x, 1)), df.schema).collect()[0]
    assert np.array_equal(np.frombuffer(out.data).reshape(5, 5), K.extreme(a, 1))


def test_pyramid_round_trip():
    for shape in ((8, 8), (9, 6), (33, 50)):
        a = np.random.default_rng(5).random(shape)
        assert np.allclose(K.collapse(K.laplacian_pyramid(a, R.kernel_of_radius(2), 2)), a, atol=1e-12)


def test_blend_follows_its_mask():
    a, k = np.random.default_rng(6).random((8, 8)), R.kernel_of_radius(2)
    assert np.array_equal(K.laplacian_blend(a, 1 - a, np.zeros((8, 8)), k, 2), a)
    assert np.allclose(K.laplacian_blend(a, 1 - a, np.ones((8, 8)), k, 2), 1 - a, atol=1e-12)


def test_lanczos_keeps_what_it_should():
    a = np.random.default_rng(7).random((9, 13))
    assert np.allclose(K.lanczos(a, 9, 13), a, atol=1e-12) and np.allclose(K.lanczos(np.full((5, 7), 0.3), 11, 20), 0.3, atol=1e-12)


def test_workflow_files(spark, tmp_path):
    node = '{"1": {"class_type": "LoadImage", "inputs": {"image": "a.png"}, "_meta": {"title": "In"}}, "2": {"class_type": "Save", "inputs": {"images": ["1", 0], "n": 2}}}'
    for name, text in (("bare", node), ("wrapped", f'{{"prompt": {node}, "client_id": "x"}}'), ("none", "[1, 2"), ("empty", "{}")):
        (tmp_path / f"{name}.json").write_text(text)
    rows = W.read(spark, str(tmp_path), "skip").collect()
    assert {(r.workflow, r.node_id, r.class_type, r.title) for r in rows} == {
        (w, *n) for w in ("bare", "wrapped") for n in (("1", "LoadImage", "In"), ("2", "Save", None))}
    edges = G.edges_of(W.read(spark, str(tmp_path), "skip").where("workflow = 'wrapped'")).collect()
    assert [(e.src, e.src_slot, e.dst, e.input) for e in edges] == [("1", 0, "2", "images")]


def test_components_snake():
    m = np.array([[1, 1, 0, 0], [0, 0, 1, 0], [1, 0, 0, 1], [1, 0, 0, 1]])
    lab = K.label(m)
    assert len(set(lab[m > 0])) == 2 and (lab[m == 0] == 0).all()


def test_graph_cycle_and_depth(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("x", "y")], "src string, dst string")
    sinks = spark.createDataFrame([("c",)], "node string")
    assert col(G.live(edges, sinks), "node") == ["a", "b", "c"]
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    with pytest.raises(ValueError):
        G.depths(edges, nodes)


def test_event_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "", None, 0), (2, "x", "y", 7)], "i int, reason string, stage string, exit_code int")
    cols = {"event": F.lit("stage_end"), "status": F.lit("success"), "reason": F.col("reason"), "stage": F.col("stage"), "exit_code": F.col("exit_code")}
    records = df.select(J.event_json(cols).alias("value"))
    assert [json.loads(r.value).get("exit_code") for r in records.collect()] == [0, 7]
    J.append_events(records, str(tmp_path / "ev"))
    J.append_events(spark.createDataFrame([("not json",)], "value string"), str(tmp_path / "ev"))
    back = J.read_events(spark, str(tmp_path / "ev"))
    assert back.where("event = 'stage_end'").count() == 2 and back.cache().where("_corrupt is not null").count() == 1


def test_plan_and_pairs(spark, tmp_path):
    plan = spark.createDataFrame([("0", 1, *["x"] * 8)], ", ".join(f"{c} {'int' if c == 'idx' else 'string'}" for c in J.PLAN_COLUMNS))
    J.write_plan(plan, str(tmp_path / "plan"))
    J.write_plan(plan, str(tmp_path / "plan"))
    assert J.read_plan(spark, str(tmp_path / "plan")).count() == 2
    (tmp_path / "kv").write_text("a=1\nb=x=y\nnothing\n")
    assert col(J.read_pairs(spark, str(tmp_path / "kv")), "key", "value") == [("a", "1"), ("b", "x=y")]


def test_images(spark, tmp_path):
    a = np.arange(30, dtype=np.uint8).reshape(5, 6)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.png").write_bytes(I.png(a.tobytes(), 5, 6))
    (tmp_path / "sub" / "b.PNG").write_bytes(I.png(a.tobytes(), 5, 6))
    (tmp_path / "bad.jpg").write_bytes(b"no image")
    (tmp_path / "t.txt").write_text("x")
    assert col(I.inventory(spark, str(tmp_path)), "rel_path") == ["a.png", "bad.jpg", "sub/b.PNG"]
    assert col(I.inventory(spark, str(tmp_path), recursive=False), "rel_path") == ["a.png", "bad.jpg"]
    assert I.decode(spark, str(tmp_path / "a.png")).collect()[0].height == 5
    g = I.gray(I.decode(spark, str(tmp_path), "skip")).collect()
    assert all(np.array_equal(np.frombuffer(r.data, np.uint8).reshape(5, 6), a) for r in g) and g
    assert not I.decode(spark, str(tmp_path / "bad.jpg")).collect()[0].ok


def test_event_stream(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i, (t, s) in enumerate([("2026-01-01T00:01:00Z", "failure"), ("2026-01-01T00:02:00Z", "success"), ("2026-01-01T09:00:00Z", "success")]):
        (src / f"{i}.json").write_text(json.dumps({"ts": t, "event": "stage_end", "status": s, "stage": "mask"}) + "\n")
    E.write_available(E.stage_windows(E.event_stream(spark, str(src))), out, str(tmp_path / "cp")).awaitTermination()
    assert col(spark.read.parquet(out), "n", "n_failures") == [(2, 1)]


def test_roi_blur_touches_components_only():
    a = np.random.default_rng(8).random((12, 12))
    m = np.zeros((12, 12), bool)
    m[2:5, 3:6] = True
    m[9, 9] = True  # below the least area
    out = K.roi_blur(a, m, R.kernel_of_sigma(0.9), 2, 4)
    assert np.array_equal(out[~m], a[~m]) and out[9, 9] == a[9, 9]
    assert np.allclose(out[2:5, 3:6], K.convolve(a[0:7, 1:8], R.kernel_of_sigma(0.9))[2:5, 2:5])


def test_cube_faces_of_a_sphere():
    """A raster of each direction's own coordinate gives the coordinate on every face."""
    h, w = 256, 512
    lat = (0.5 - (np.arange(h) + 0.5) / h) * np.pi
    up = np.broadcast_to(np.sin(lat)[:, None], (h, w))
    cube = K.equirect_to_cube(up, 8).reshape(6, 8, 8)
    for face, got in zip("FRBLUD", cube, strict=True):
        assert np.allclose(got, K.directions(face, 8)[..., 1], atol=1e-3)


def test_png_errors(spark):
    df = spark.createDataFrame([(1, bytearray(I.png(b"\x01\x02", 1, 2))), (2, bytearray(b"junk")), (3, None)], "img long, png binary")
    assert col(I.decoded(df), "img", "ok") == [(1, True), (2, False), (3, False)]


def test_png_filters_and_colours():
    rng = np.random.default_rng(3)
    for colour, bpp in ((0, 1), (2, 3), (3, 1), (4, 2), (6, 4)):
        h, w = 6, 5
        px = rng.integers(0, 256, (h, w, bpp)).astype(np.uint8)
        table = rng.integers(0, 256, (256, 3)).astype(np.uint8)
        flat, raw = px.reshape(h, -1).astype(int), b""
        for y in range(h):  # row y is filtered by kind y, the last by none
            kind = y % 5
            line = []
            for i in range(w * bpp):
                left = flat[y, i - bpp] if i >= bpp else 0
                up = flat[y - 1, i] if y else 0
                corner = flat[y - 1, i - bpp] if y and i >= bpp else 0
                d = [(abs(up - corner), 0, left), (abs(left - corner), 1, up), (abs(left + up - 2 * corner), 2, corner)]
                line.append((flat[y, i] - [0, left, up, (left + up) // 2, min(d)[2]][kind]) % 256)
            raw += bytes([kind, *line])
        chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
        head = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + (chunk(b"PLTE", table.tobytes()) if colour == 3 else b"")
        data = b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
        rgb = table[px[..., 0]] if colour == 3 else px[..., :3]
        want = px[..., 0] if colour in (0, 4) else (rgb.astype(float) @ (0.299, 0.587, 0.114)).round().astype(np.uint8)
        assert (I.gray_of_png(data) == want).all()
    for bad in (data[:20], b"x" * 60, data[:24] + b"\x10" + data[25:]):
        with pytest.raises((ValueError, struct.error, zlib.error)):
            I.gray_of_png(bad)


def test_contour_centroids():
    a = np.zeros((9, 9), bool)
    assert K.contour_centroids(a) == []
    a[1:4, 1:6] = True  # a rectangle of 2 x 4 with a hole at its middle, which the contour encloses
    a[2, 3] = False
    a[6, 2] = a[7, 1] = True  # a line: no area
    a[6:8, 6] = a[7, 7] = True  # a triangle
    out = K.contour_centroids(a)
    assert [(x, y) for _, x, y in out[:1]] == [(3.0, 2.0)]
    assert (2.0, 6.0) in [(x, y) for _, x, y in out]
    assert any(abs(x - (6 + 1 / 3)) < 1e-9 and abs(y - (6 + 2 / 3)) < 1e-9 for _, x, y in out)
    assert len(out) == 3
