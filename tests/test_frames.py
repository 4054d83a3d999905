"""Frames: spheres, sizes, contours, files, models and workflows on fixtures, against plain versions."""

import json
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyloom.functions import contours as C
from skyloom.functions import jpeg, nodes, scaling, sky, sphere
from skyloom.functions import kernels as K
from skyloom.operators import assets as A
from skyloom.operators import frames as FR
from skyloom.operators import models as M
from skyloom.operators import workflow_run as W
from skyloom.sources import image_sink as S
from skyloom.sources import images as I
from skyloom.sources import workflows

RNG = np.random.default_rng


def smooth(h, w, c=3):
    """A frame that is smooth on the sphere: linear in the directions of its pixels."""
    lon, lat = ((np.arange(w) + 0.5) / w - 0.5) * 2 * np.pi, (0.5 - (np.arange(h) + 0.5) / h) * np.pi
    d = np.stack([np.cos(lat)[:, None] * np.sin(lon), np.broadcast_to(np.sin(lat)[:, None], (h, w)), np.cos(lat)[:, None] * np.cos(lon)], axis=-1)
    return 0.5 + 0.4 * d[..., :c]


def frame_rows(spark, arrays):
    rows = [(i, *a.shape, a.ravel().tolist()) for i, a in arrays.items()]
    return spark.createDataFrame(rows, FR.FRAME)


def back(df):
    return {r.img: np.array(r.data).reshape(r.h, r.w, r.c) for r in df.collect()}


def test_cube_round_trip():
    """Through faces and back a smooth panorama changes by less than the squared size of a pixel."""
    for h, w, n in ((64, 128, 32), (60, 120, 48), (31, 65, 20)):
        a = smooth(h, w)
        assert np.abs(sphere.panorama_of(sphere.faces_of(a, n), h, w) - a).max() < 0.4 * (np.pi / 2 / n) ** 2 + 0.4 * (np.pi / h) ** 2
    flat = np.full((6, 5, 5, 3), 0.25)
    assert np.allclose(sphere.panorama_of(flat, 9, 18), 0.25, atol=1e-12)


def test_faces_own_their_middle():
    faces = np.stack([np.full((9, 9), float(k)) for k in range(6)])
    out = sphere.panorama_of(faces, 90, 180)
    middle = {"F": (45, 90), "R": (45, 135), "B": (45, 0), "L": (45, 45), "U": (0, 90), "D": (89, 90)}
    assert {f: out[p] for f, p in middle.items()} == {f: float(k) for k, f in enumerate("FRBLUD")}
    d = RNG(1).normal(size=(500, 3))
    face, u, v = sphere.face_places(d)
    assert (np.abs(u) <= 1).all() and (np.abs(v) <= 1).all()
    again = sphere._on_plane(face, u, v)
    assert np.allclose(again / np.linalg.norm(again, axis=1, keepdims=True), d / np.linalg.norm(d, axis=1, keepdims=True))


@pytest.mark.parametrize("yaw, pitch", [(0, 0), (30, -20), (180, 50), (-170, -70)])
def test_patch_against_pixel_loop(yaw, pitch):
    h, w, ph, pw, fov, feather = 14, 28, 9, 11, (100.0, 70.0), 1
    base, patch = RNG(2).random((h, w, 3)), RNG(3).random((ph, pw, 3))
    merged, warped, alpha = sphere.patched(base, patch, fov, yaw, pitch, feather)
    seen, want = np.zeros((h, w)), np.zeros((h, w, 3))
    u, v = math.radians(yaw), math.radians(pitch)
    for y in range(h):
        for x in range(w):
            lon, lat = (x / w - 0.5) * 2 * math.pi + u, (0.5 - y / h) * math.pi
            right, up, ahead = math.cos(lat) * math.sin(lon), math.sin(lat), math.cos(lat) * math.cos(lon)
            up, ahead = up * math.cos(v) - ahead * math.sin(v), up * math.sin(v) + ahead * math.cos(v)
            if ahead <= 1e-9 or abs(right / ahead) > math.tan(math.radians(fov[0] / 2)) or abs(up / ahead) > math.tan(math.radians(fov[1] / 2)):
                continue
            seen[y, x] = 1
            px = (right / ahead / math.tan(math.radians(fov[0] / 2)) + 1) / 2 * pw
            py = (1 - up / ahead / math.tan(math.radians(fov[1] / 2))) / 2 * ph
            for j in range(ph):
                for i in range(pw):
                    want[y, x] += patch[j, i] * max(0, 1 - abs(px - i)) * max(0, 1 - abs(py - j))
    assert np.allclose(warped, want)
    eroded = np.array([[seen[max(0, y - 1) : y + 2, max(0, x - 1) : x + 2].min() for x in range(w)] for y in range(h)])
    assert (alpha[eroded == 0].max() < 1) and np.allclose(merged, base * (1 - alpha[..., None]) + want * alpha[..., None])
    hard = sphere.patched(base, patch, fov, yaw, pitch, 0)[2]
    assert (hard == seen).all() and hard.any() and not hard.all()


def test_repaired_view_keeps_the_rest():
    """A view of a smooth panorama laid back unchanged changes little; an empty one is seen where it was."""
    a = smooth(60, 120)
    hole = np.ones((64, 64), bool)
    for yaw, pitch in ((180.0, 50.0), (40.0, -30.0)):
        same = sphere.repaired_view(a, lambda v, _: v, hole, yaw=yaw, pitch=pitch, feather=2)
        assert np.abs(same - a).max() < 0.06
        black = sphere.repaired_view(a, lambda v, _: v * 0, hole, yaw=yaw, pitch=pitch, feather=2)
        changed = np.abs(black - a).sum(axis=2) > 0.1
        y, x = np.nonzero(changed)
        lon = np.radians((x + 0.5) / 120 * 360 - 180 - yaw)
        lat = 90 - (y.mean() + 0.5) / 60 * 180
        assert changed.mean() > 0.03 and np.cos(lon).mean() > 0.3 and lat * pitch > 0


def test_seam_strip_and_repair():
    for w in (7, 8, 40):
        columns, far = K.seam_strip(w, 2, 3)
        assert len(set(columns.tolist())) == len(columns) <= w and (np.diff(far) == 1).all() and far[0] < 0
    a = RNG(8).random((4, 40, 3))
    out = K.repaired_seam(a, lambda v, weight: np.where(weight[..., None] > 0.5, 9.0, v), 2, 3, 2, 0)
    assert np.array_equal(out[:, 2:38], a[:, 2:38]) and (out[:, [0, 1, 38, 39]] == 9).all()
    seen = []
    K.repaired_seam(a, lambda v, weight: (seen.append(weight), v)[1], 2, 6, 2, 3.0)
    assert seen[0].shape == (4, 16) and 0 < seen[0][0, 0] < seen[0][0, 5] < seen[0][0, 7] < 1


def test_sky_replacement():
    base, new = np.full((16, 32, 3), 0.2), np.full((8, 16, 3), 0.9)
    mask = np.zeros((24, 40))
    mask[:12] = 1
    out = sky.replaced(base, new, mask, levels=2)
    assert np.allclose(out[0], 0.9, atol=0.02) and np.allclose(out[-1], 0.2, atol=0.02)
    assert np.allclose(sky.replaced(base, new, 1 - mask, levels=2), out)  # turned the right way
    assert sky.replaced(base, new, np.zeros((24, 40))) is base
    assert np.allclose(sky.replaced(base, np.full((16, 32, 3), 0.9), np.ones((4, 8)), levels=3), 0.9)
    assert sky.aligned(np.tile(np.arange(40) / 40, (10, 1)), 20, 20).mean() == pytest.approx(0.4875, abs=0.02)


def test_resize_weights():
    for how in ("area", "nearest", "bilinear", "bicubic", "lanczos"):
        for n, to in ((7, 3), (3, 7), (5, 5), (16, 1), (1, 4), (10, 9)):
            w = scaling.weights(n, to, how)
            assert w.shape == (to, n) and np.allclose(w.sum(axis=1), 1)
        assert np.allclose(scaling.weights(6, 6, how), np.eye(6))
    for n, to in ((7, 3), (16, 5)):  # the mean over each target's extent
        fine = np.repeat(np.arange(n, dtype=float), to)
        assert np.allclose(scaling.weights(n, to, "area") @ np.arange(n), fine.reshape(to, n).mean(axis=1))
    a = RNG(4).random((5, 9, 3))
    assert scaling.resized(a, 4, 6, "area").shape == (4, 6, 3)
    assert np.allclose(scaling.resized(a, 10, 18, "bilinear"), np.stack([K.resize(a[..., k], 10, 18) for k in range(3)], axis=-1))
    with pytest.raises(ValueError, match="unknown way"):
        scaling.weights(3, 3, "magic")


def test_size_rules():
    size = scaling.target_size
    assert size(1000, 2000, 512, 512) == (256, 512) and size(100, 200, 512, 512) == (256, 512)
    assert size(100, 200, 512, 512, condition="downscale if bigger") == (100, 200) and size(1000, 200, 512, 512, condition="downscale if bigger") == (512, 102)
    assert size(100, 200, 512, 512, condition="upscale if smaller") == (256, 512) and size(100, 600, 512, 512, condition="upscale if smaller") == (100, 600)
    assert size(100, 200, 30, 50, "stretch") == (30, 50) and size(100, 200, 0, 50, "stretch") == (100, 50)
    assert size(100, 200, 0, 50) == (25, 50) and size(100, 200, 50, 0) == (50, 100) and size(100, 200, 0, 0) == (100, 200)
    assert size(100, 200, 512, 512, multiple=100) == (200, 500) and size(10, 20, 7, 7, multiple=8) == (8, 8)
    for bad in ({"method": "x"}, {"condition": "x"}, {"multiple": 0}):
        with pytest.raises(ValueError):
            size(1, 1, 1, 1, **bad)


def test_preferred_sizes():
    assert scaling.preferred_size(100, 100) == (1024, 1024) and scaling.preferred_size(100, 1000) == (672, 1568) and scaling.preferred_size(1000, 10) == (1568, 672)
    for h, w in ((100, 200), (200, 100), (333, 333), (90, 101)):
        th, tw = scaling.preferred_size(h, w)
        assert all(abs(w / h - tw / th) <= abs(w / h - a / b) for a, b in scaling.PREFERRED)
        y, x = scaling.middle(h, w, th, tw)
        assert min(x, y) == 0 and abs((w - 2 * x) / (h - 2 * y) - tw / th) < 0.03
    out = scaling.scaled_to_preferred(smooth(60, 120))
    assert out.shape == (752, 1392, 3) or out.shape[:2] == scaling.preferred_size(60, 120)
    assert W.KERNELS["FluxKontextImageScale"](image=np.full((8, 8, 3), 0.5)).shape == (1024, 1024, 3)


def test_padding_and_back():
    a = RNG(5).random((5, 8, 3))
    for mode, other in (("edge", "edge"), ("reflect", "reflect"), ("zero", "constant")):
        for t, b, l, r in ((0, 0, 0, 0), (1, 3, 2, 0), (4, 4, 7, 7)):
            out = scaling.padded(a, t, b, l, r, mode)
            assert np.array_equal(out, np.pad(a, ((t, b), (l, r), (0, 0)), other)) and np.array_equal(scaling.unpadded(out, t, b, l, r), a)
    assert scaling.to_multiple(5, 8, 4) == (0, 3, 0, 0) and scaling.to_square(5, 8) == (1, 2, 0, 0) and scaling.to_square(8, 5) == (0, 0, 1, 2)
    assert np.array_equal(scaling.padded(a[:1], 3, 3, 0, 0, "reflect")[:, 0, 0], np.repeat(a[0, 0, 0], 7))


MASKS = ["""
....#....
...###...
.#.....#.
.##...##.
..#####..
.........
#........""", """
#######.#
#.....#..
#.###.#..
#.#.#.#.#
#.###.#..
#.....#..
#######..""", "#", ".", "####", "#\n#\n#", "##\n##"]


@pytest.mark.parametrize("text", MASKS)
def test_contours_against_borders(text):
    mask = np.array([[c == "#" for c in line] for line in text.strip("\n").split("\n")])
    lab = K.label(mask)
    wide = np.pad(lab, 1)
    out, todo = {(0, 0)}, [(0, 0)]
    while todo:  # plain flood fill from the frame
        y, x = todo.pop()
        for p in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
            if 0 <= p[0] < wide.shape[0] and 0 <= p[1] < wide.shape[1] and not wide[p] and p not in out:
                out.add(p)
                todo.append(p)
    border = {}
    for y, x in zip(*np.nonzero(lab), strict=True):
        if out & {(y + 2, x + 1), (y, x + 1), (y + 1, x + 2), (y + 1, x)}:
            border.setdefault(int(lab[y, x]), set()).add((int(y), int(x)))
    found = C.outer_contours(mask)
    assert {n: set(p) for n, p in found} == border
    for n, points in found:
        assert points[0] == divmod(n - 1, mask.shape[1])
        if len(points) > 1:
            assert all(max(abs(a - c), abs(b - d)) == 1 for (a, b), (c, d) in zip(points, points[1:] + points[:1], strict=True))
        turns = C.corners(points)
        drawn = C.stroke(*mask.shape, turns, 0.0)
        assert {tuple(p) for p in np.argwhere(drawn)} == set(points)  # straight runs between the corners hold the other points


def test_contours_of_noise():
    for k in range(20):
        mask = RNG(k).random((12, 17)) > 0.55
        for n, points in C.outer_contours(mask):
            assert all(mask[p] for p in points) and len(points) <= 4 * mask.sum()
            assert K.label(mask)[points[0]] == n


def test_strokes_and_labels():
    points = [(2, 2), (2, 9), (7, 5)]
    for thickness in (1.0, 2.0, 3.5):
        on = C.stroke(12, 14, points, thickness)
        for y in range(12):
            for x in range(14):
                near = []
                for (y0, x0), (y1, x1) in zip(points, points[1:] + points[:1], strict=True):
                    t = min(1, max(0, ((y - y0) * (y1 - y0) + (x - x0) * (x1 - x0)) / ((y1 - y0) ** 2 + (x1 - x0) ** 2)))
                    near.append(math.dist((y, x), (y0 + t * (y1 - y0), x0 + t * (x1 - x0))))
                assert on[y, x] == (min(near) <= thickness / 2 + 1e-9)
    assert C.enclosed([(0, 0), (0, 4), (3, 4), (3, 0)]) == 12 and C.centroid([(0, 0), (0, 4), (3, 4), (3, 0)]) == (1.5, 2.0)
    assert C.text_mask("F 0.87").shape == (7, 35) and C.text_mask("").shape == (7, 0)
    a = np.zeros((40, 60, 3))
    mask = np.zeros((40, 60), bool)
    mask[5:30, 10:50] = True
    out = C.annotated(a, mask, "LP 0.92", (0.0, 0.0, 1.0))
    assert (out[5, 10:50] == (0, 0, 1)).all() and (out[18, 31] != 0).any() and (out[0] == 0).all() and (a == 0).all()
    assert np.array_equal(C.annotated(a, mask, "F", (1, 0, 0), least_area=1e9), a)


def test_jpeg_files_open(spark, tmp_path):
    """Spark's image reader opens the files; errors fall with the quality."""
    made = {}
    for h, w, c in ((8, 8, 1), (1, 1, 3), (17, 33, 3), (64, 48, 3)):
        a = (smooth(h, w, c) * 255).astype(np.uint8)
        for q in (1, 30, 85, 100):
            for halved in (True, False):
                name = f"{h}_{w}_{q}_{int(halved)}.jpg"
                (tmp_path / name).write_bytes(jpeg.encoded(a, q, halved))
                made[name] = a
    rows = S.read_images(spark, str(tmp_path)).collect()
    assert {r.path for r in rows} == set(made)
    error = {}
    for r in rows:
        got = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels)
        error[r.path] = np.abs(got.astype(int) - made[r.path]).mean()
    assert all(e < (2.5 if "_100_" in n else 4 if "_85_" in n else 60) for n, e in error.items())
    assert error["64_48_1_0.jpg"] > error["64_48_85_0.jpg"] > error["64_48_100_0.jpg"]
    noise = RNG(1).integers(0, 256, (40, 56, 3)).astype(np.uint8)
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "noise.jpg").write_bytes(jpeg.encoded(noise, 100, False))
    r = S.read_images(spark, str(tmp_path / "n")).first()
    assert np.abs(np.frombuffer(r.data, np.uint8).astype(int) - noise.ravel()).mean() < 1
    for bad in (np.zeros((0, 4), np.uint8), np.zeros((4, 4, 2), np.uint8), np.zeros((4, 4))):
        with pytest.raises(ValueError):
            jpeg.encoded(bad)
    with pytest.raises(ValueError):
        jpeg.steps(0, jpeg.LUMA)


def test_code_lengths_are_bounded():
    fib = [1, 1]
    while len(fib) < 40:
        fib.append(fib[-1] + fib[-2])
    for counts in ({0: 5}, dict(enumerate(fib)), {s: 1 for s in range(200)}):
        lengths = jpeg.code_lengths(counts)
        assert {s for s, _ in lengths} == set(counts) and max(n for _, n in lengths) <= 16
        assert sum(2.0**-n for _, n in lengths) < 1  # all ones stays free


def test_png_sink_and_reruns(spark, tmp_path):
    a = {i: RNG(i).integers(0, 256, (3 + i % 2, 5, 3)).astype(np.uint8) for i in range(12)}
    rows = spark.createDataFrame([(f"d{i % 3}/f{i}.png", *v.shape, bytearray(v.tobytes())) for i, v in a.items()], S.SCHEMA).repartition(4)
    folder = str(tmp_path / "out")
    for _ in range(2):
        S.write_images(rows, folder)
        got = {r.path: np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels) for r in S.read_images(spark, folder).collect()}
        assert set(got) == {f"d{i % 3}/f{i}.png" for i in a} and all(np.array_equal(got[f"d{i % 3}/f{i}.png"], v) for i, v in a.items())
        assert sorted(os.listdir(folder)) == ["d0", "d1", "d2"]
    S.write_images(rows.where("path LIKE 'd0/%'"), folder, overwrite=True)
    assert S.read_images(spark, folder).count() == 4
    gray = spark.createDataFrame([("g.png", 2, 3, 1, bytearray(range(6)))], S.SCHEMA)
    S.write_images(gray, "file:" + folder)
    assert bytes(I.gray_of_png(open(f"{folder}/g.png", "rb").read()).ravel()) == bytes(range(6))


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    folder = str(tmp_path / "out")
    ok = [(f"f{i}.png", 1, 1, 3, bytearray(b"abc")) for i in range(6)]
    for bad in (("x.bmp", 1, 1, 3, bytearray(b"abc")), ("../x.png", 1, 1, 3, bytearray(b"abc")), ("x.png", 2, 2, 3, bytearray(b"abc"))):
        with pytest.raises(Exception):
            S.write_images(spark.createDataFrame([*ok, bad], S.SCHEMA).repartition(3), folder)
        assert not os.path.exists(folder) or [f for _, _, fs in os.walk(folder) for f in fs] == []
    with pytest.raises(ValueError, match="2 images have the path"):
        S.write_images(spark.createDataFrame([ok[0], ok[0]], S.SCHEMA), folder)
    S.write_images(spark.createDataFrame(ok, S.SCHEMA), folder)
    assert len(os.listdir(folder)) == 6
    spark.dataSource.register(S.ImageFiles)
    with pytest.raises(Exception, match="columns must be"):
        spark.range(1).write.format("image_files").option("path", folder).mode("append").save()


def test_nodes_from_sql(spark):
    nodes.register(spark)
    a = {1: RNG(1).random((6, 12, 3)), 2: RNG(2).random((8, 16, 3))}
    frames_ = frame_rows(spark, a).withColumn("name", F.lit("n"))
    frames_.createOrReplaceTempView("frames_view")
    rows = spark.sql("SELECT * FROM resize_frames(TABLE(frames_view), width => 6, height => 6)").collect()
    assert {(r.img, r.name, r.h, r.w, r.c) for r in rows} == {(1, "n", 3, 6, 3), (2, "n", 3, 6, 3)}
    for r in rows:
        assert np.allclose(np.array(r.data).reshape(3, 6, 3), scaling.resized(a[r.img], 3, 6, "area"))
    for call, message in (("width => 70000", "goes from"), ("width => 1.5", "whole number"), ("size => 3", "unknown parameter"), ("width => NULL", "whole number")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM resize_frames(TABLE(frames_view), {call})")
    with pytest.raises(Exception, match="lacks p_h"):
        spark.sql("SELECT * FROM perspective_to_equirectangular(TABLE(frames_view))")


def _failing(after):
    def load():
        def model(frames):
            if any(a.shape[0] > after for a in frames):
                raise RuntimeError("too high")
            return [a * 2 for a in frames]

        return model

    return load


def test_model_slot(spark):
    a = {i: np.full((2 + i % 4, 3, 1), float(i)) for i in range(40)}
    slot = M.Slot("failing", _failing(4), (), batch_bytes=3 * 2 * 8 * 2)
    rows = M.applied(frame_rows(spark, a).repartition(6), slot).collect()
    assert len(rows) == 40
    for r in rows:
        if a[r.img].shape[0] > 4:
            assert r.error == "RuntimeError: too high" and r.data is None and r.h is None
        else:
            assert r.error is None and r.data == (a[r.img] * 2).ravel().tolist()
    assert {r.loads for r in rows} == {1}
    again = M.applied(frame_rows(spark, a).repartition(6), slot).collect()
    assert {r.loads for r in again} == {1}  # workers are used again, and so is the model
    assert [len(b) for b in M._by_bytes([np.zeros(4)] * 5, 64)] == [2, 2, 1] and [len(b) for b in M._by_bytes([np.zeros(400)] * 2, 64)] == [1, 1]


def test_tasks_work_in_small_pieces():
    """What a large Arrow batch becomes is given away piece by piece."""
    n = 3000
    e = pa.record_batch({"img": pa.array(range(n), pa.int64()), "e": pa.array(RNG(0).random((n, 64)).astype(np.float32).tolist(), pa.list_(pa.float32()))})
    out = list(K.each_embedding(8, lambda a: [a[:2, :2]])(iter([e])))
    assert max(b.num_rows for b in out) <= 4 * K.PIECE_ROWS and sum(b.num_rows for b in out) == 4 * n
    assert np.array_equal(np.concatenate([b["img"].to_numpy() for b in out]), np.repeat(np.arange(n), 4))
    want = (np.array(e["e"].to_pylist()).reshape(n, 8, 8)[:, :2, :2].ravel() + 1) / 2
    assert np.allclose(np.concatenate([b["v"].to_numpy() for b in out]), want)
    assert [b.num_rows for b in K.pieces(iter([e]), n, e.nbytes // 3)][0] <= n // 3 and [b.num_rows for b in K.pieces(iter([e.slice(0, 2)]), n, 1)] == [1, 1]


class _Noted:
    """Stands for a table: notes the functions that its batches go through."""

    schema = ()

    def __init__(self):
        self.runs = []

    def mapInArrow(self, run, schema):
        self.runs.append(run)
        return self

    def __getattr__(self, name):
        return lambda *a, **k: self


def test_cube_masks_in_small_pieces(spark):
    """Neither faces nor masks of a whole Arrow batch are held at once."""
    table, n = _Noted(), 600
    M.cube_masks(table, M.Slot("t-spread", M.spread_brightness), 4)
    split, applied, join = table.runs
    frames = FR.batch_of(list(range(n)), list(RNG(1).random((n, 8, 16, 3))))
    faces = list(split(iter([frames])))
    assert max(b.num_rows for b in faces) <= 5 * K.PIECE_ROWS and sum(b.num_rows for b in faces) == 5 * n
    assert sum(b.num_rows for b in applied(iter(faces))) == 5 * n
    one = [{"face": f, "h": 4, "w": 4, "data": [0.5] * 16} for f in "FRBLU"]
    rows = pa.RecordBatch.from_pylist([{"img": i, "faces": one, "height": 8, "width": 16} for i in range(n)])
    masks = list(join(iter([rows])))
    assert max(b.num_rows for b in masks) <= K.PIECE_ROWS and [i for b in masks for i in b["img"].to_pylist()] == list(range(n))


def test_cube_masks(spark):
    a = {1: smooth(16, 32), 2: smooth(8, 16)}
    slot = M.Slot("spread", M.spread_brightness, (("reach", 1),))
    got = back(M.cube_masks(frame_rows(spark, a), slot, 6, "FRBLU", 1, 0.5).drop("error"))
    for i, v in a.items():
        cube = sphere.faces_of(v, 6)
        masks = np.zeros((6, 6, 6))
        for k in range(5):
            g = cube[k].mean(axis=2)
            masks[k] = np.array([[max(g[abs(y + dy) if y + dy < 6 else 10 - y - dy, abs(x + dx) if x + dx < 6 else 10 - x - dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)) for x in range(6)] for y in range(6)]) >= 0.5
        assert np.allclose(got[i][..., 0], sphere.panorama_of(masks, *v.shape[:2]))
    refuse = M.Slot("brightness", M.brightness_mask, (("least_rows", 100),))
    rows = M.cube_masks(frame_rows(spark, a), refuse, 6).collect()
    assert {(r.img, r.error, r.data) for r in rows} == {(i, "ValueError: 6 rows are too few", None) for i in a}


def nodes_of(**extra):
    n = {
        "1": {"class_type": "LoadImage", "inputs": {}}, "2": {"class_type": "ImageCrop", "inputs": {"image": ["1", 0], "width": 4, "height": 2, "x": 1, "y": 1}},
        "3": {"class_type": "EmptyImage", "inputs": {"width": 4, "height": 2, "color": 16711680}},
        "4": {"class_type": "ImageCompositeMasked", "inputs": {"destination": ["1", 0], "source": ["3", 0], "x": -1, "y": 3}},
        "5": {"class_type": "ResizeAndPadImage", "inputs": {"image": ["2", 0], "target_width": 4, "target_height": 4, "padding_color": "white"}},
        "7": {"class_type": "Image Save", "inputs": {"images": ["4", 0]}}, "8": {"class_type": "Image Save", "inputs": {"images": ["5", 0]}}}
    return json.dumps(n | extra)


def test_workflow_on_frames(spark):
    a = {1: RNG(1).random((6, 8, 3)), 2: RNG(2).random((4, 9, 3))}
    df = frame_rows(spark, a)
    rows = W.run(nodes_of(**{"9": {"class_type": "KSampler", "inputs": {"x": ["8", 0]}}}), {"1": df}).collect()
    got = {(r.img, r.node): np.array(r.data).reshape(r.h, r.w, r.c) for r in rows}
    assert set(got) == {(i, n) for i in a for n in ("7", "8")} and all(r.error is None for r in rows)
    for i, v in a.items():
        red = v.copy()
        red[3:5, :3] = (1, 0, 0)
        assert np.allclose(got[i, "7"], red)
        box = np.ones((4, 4, 3))
        box[1:3] = v[1:3, 1:5]
        assert np.allclose(got[i, "8"], box)


def test_workflow_projection_with_a_model(spark):
    """A view is cut out, goes through a model, is resized and laid back: as by hand."""
    text = json.dumps({"prompt": {
        "91": {"class_type": "LoadImage", "inputs": {"image": "x.jpg"}},
        "28": {"class_type": "Equirectangular to Perspective", "inputs": {"fov_deg_h": 80, "fov_deg_v": 80, "h_deg": 180, "v_deg": -40, "out_h": 8, "out_w": 8, "in_rot_deg": 0, "e_img": ["91", 0]}},
        "37": {"class_type": "KSampler", "inputs": {"latent_image": ["28", 0], "model": ["99", 0]}},
        "36": {"class_type": "ImageResize+", "inputs": {"width": 12, "height": 12, "interpolation": "bicubic", "method": "stretch", "condition": "always", "multiple_of": 0, "image": ["37", 0]}},
        "45": {"class_type": "Perspective to Equirectangular", "inputs": {"fov_w": 80, "fov_h": 80, "u_deg": 180, "v_deg": -40, "feather": 1, "perspective": ["36", 0], "equi_base": ["91", 0]}},
        "59": {"class_type": "Image Save", "inputs": {"images": ["45", 0]}}}})
    a = smooth(20, 40)
    double = M.Slot("double", _failing(100), ())
    out = back(W.run(text, {"91": frame_rows(spark, {5: a})}, models={"KSampler": double}).drop("node", "error"))
    view = np.clip(scaling.resized(sphere.view_of(a, (80, 80), 180, -40, 8, 8) * 2, 12, 12, "bicubic"), 0, 1)
    assert np.allclose(out[5], sphere.patched(a, view, (80, 80), 180, -40, 1)[0])
    failing = M.Slot("refusing", _failing(3), ())
    r = W.run(text, {"91": frame_rows(spark, {5: a})}, models={"37": failing}).first()
    assert r.error == "ValueError: RuntimeError: too high" and r.node is None and r.data is None or r.h == 0


def test_workflow_errors(spark):
    link = lambda to: {"class_type": "MaskToImage", "inputs": {"mask": [to, 0]}}
    for extra, message in (
            ({"4": link("4")}, "cycle"), ({"4": link("5"), "5": link("4")}, "cycle"), ({"4": link("77")}, "missing"),
            ({"4": {"class_type": "VAEDecode", "inputs": {}}}, "no kernel or model for VAEDecode")):
        with pytest.raises(ValueError, match=message):
            W.compiled(nodes_of(**extra))
    with pytest.raises(ValueError, match="no Image Save"):
        W.compiled('{"1": {"class_type": "LoadImage", "inputs": {}}}')
    with pytest.raises(ValueError, match="not a workflow"):
        W.compiled("[1]")
    with pytest.raises(ValueError, match="without a source"):
        W.run(nodes_of(), {})
    df = frame_rows(spark, {1: np.zeros((6, 8, 3)), 2: np.zeros((1, 1, 3))})
    bad = nodes_of(**{"4": {"class_type": "ImageTile", "inputs": {"image": ["1", 0], "columns": 1, "rows": "x"}}})
    assert {(r.img, r.error is None) for r in W.run(bad, {"1": df}).collect()} == {(1, False), (2, False)}


def test_batches(spark):
    f = lambda sizes: spark.createDataFrame([(b, i, b * 10 + i) for b, n in sizes.items() for i in range(n)], "batch int, i int, frame int")
    got = {(r.batch, r.i, r.left, r.right) for r in FR.zipped(f({1: 3, 2: 1, 3: 2, 4: 1}), f({1: 3, 2: 2, 3: 1, 4: 1, 5: 2})).collect()}
    assert got == {(1, i, 10 + i, 10 + i) for i in range(3)} | {(2, i, 20, 20 + i) for i in range(2)} | {(3, i, 30 + i, 30) for i in range(2)} | {(4, 0, 40, 40)}
    with pytest.raises(Exception, match="batch 1 has 2 and 3 frames"):
        FR.zipped(f({1: 2}), f({1: 3})).collect()


def test_soft_region_blur_adds_up():
    a = RNG(6).random((12, 20, 3))
    mask = np.zeros((12, 20))
    mask[2:5, 2:6], mask[2:5, 8:12], mask[9, 9] = 0.8, 0.9, 1.0
    kernel = [(-1, 0.25), (0, 0.5), (1, 0.25)]
    out = K.soft_region_blur(a, mask, kernel, 3, 2, 0.5)
    want = a.copy()
    for y0, y1, x0, x1 in ((0, 8, 0, 9), (0, 8, 5, 15)):
        box = np.pad(a[y0:y1, x0:x1], ((1, 1), (1, 1), (0, 0)), "reflect")
        soft = sum(wy * wx * box[1 + dy : 1 + dy + y1 - y0, 1 + dx : 1 + dx + x1 - x0] for dy, wy in kernel for dx, wx in kernel)
        m = mask[y0:y1, x0:x1, None]
        want[y0:y1, x0:x1] = want[y0:y1, x0:x1] * (1 - m) + soft * m
    assert np.allclose(out, want) and (out[9, 9] == a[9, 9]).all()


@pytest.mark.parametrize("seed", range(4))
def test_renamed_as_one_after_the_other(spark, seed):
    rng = RNG(seed)
    stems = ["x", "x__dup001", "x__dup001__dup001", "x__dup002", "y", "y__dup999"]
    rows = [(f"{'abcdefghij'[rng.integers(10)]}/{i:03d}/{s}{e}", s, e, int(rng.integers(2))) for i in range(60) for s, e in [(stems[rng.integers(6)], (".jpg", ".JPG")[rng.integers(2)])]]
    if seed == 0:
        rows = [(p, p[2:-4], ".jpg", 0) for p in ("a/x.jpg", "b/x.jpg", "c/x.jpg", "d/x__dup001.jpg", "e/x__dup001.jpg", "f/x__dup001__dup001.jpg")]
    want, taken = {}, set()
    for path, stem, suffix, shard in sorted(rows, key=lambda r: r[0].split("/")):
        k = 0
        while (shard, name := stem + (f"__dup{k:03d}" if k else "") + suffix.lower()) in taken:
            k += 1
        taken.add((shard, name))
        want[path] = name
    out = A.renamed(spark.createDataFrame(rows, "rel_path string, stem string, suffix string, shard int")).collect()
    assert {r.rel_path: r.dst_name for r in out} == want and len(out) == len(rows)
    assert set(out[0].asDict()) == {"rel_path", "stem", "suffix", "shard", "dst_name"}


def test_workflow_texts(spark):
    node = '{"1": {"class_type": "LoadImage", "inputs": {"image": "a.png"}}}'
    good = {"bare": node, "nodes": f'{{"nodes": {node}, "links": []}}', "prompt": f'{{"client": 1, "prompt": {node}}}', "space": f"  {node}\n"}
    bad = {"list": "[1, 2]", "cut": "[1, 2", "empty": "{}", "other": '{"nodes": [1], "version": 3}', "none": None, "text": '"x"'}
    df = spark.createDataFrame(list((good | bad).items()), "workflow string, json string")
    assert {(r.workflow, r.node_id, r.class_type) for r in workflows.nodes(df, "skip").collect()} == {(w, "1", "LoadImage") for w in good}
    errors = {r.workflow: r.error for r in workflows.parsed(df).collect()}
    assert all(errors[w] is None for w in good) and all(errors[w] for w in bad)
    assert errors["none"] == "no text" and errors["cut"] == "not JSON" and "no nodes" in errors["other"]
    for w in bad:
        with pytest.raises(Exception, match=f"workflow {w}: "):
            workflows.nodes(df.where(F.col("workflow") == w)).collect()
