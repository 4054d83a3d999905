"""Whole stages, growing files, staged files, box suppression: against plain versions, with failures."""

import json
import os
import subprocess

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.functions import kernels as K
from skyloom.functions import scalars as S
from skyloom.functions import scaling, sphere
from skyloom.operators import boxes as B
from skyloom.operators import frames as FR
from skyloom.operators import models as M
from skyloom.operators import stages as G
from skyloom.operators.raster import kernel_of_sigma
from skyloom.sources import copies, image_sink
from skyloom.streaming import states, tail

RNG = np.random.default_rng


def frame_rows(spark, arrays):
    return spark.createDataFrame([(i, *a.shape, a.ravel().tolist()) for i, a in arrays.items()], FR.FRAME)


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)


def test_suppressed(spark):
    rng = RNG(3)
    rows = []
    for image in range(4):
        for k in range([0, 1, 30, 90][image]):
            x, y, w, h = rng.integers(0, 30, 4)
            rows.append((image, "F" if k % 2 else "LP", k, float(x), float(y), float(x + w + 1), float(y + h + 1), float(rng.integers(0, 10)) / 10))
    df = spark.createDataFrame(rows, "image int, typ string, k int, x1 double, y1 double, x2 double, y2 double, conf double")
    want = set()
    for image in range(4):
        for typ in ("F", "LP"):
            kept = []
            for r in sorted((r for r in rows if r[:2] == (image, typ)), key=lambda r: (-r[7], r[3:7], r[2])):
                if all(iou(o[3:7], r[3:7]) <= 0.4 for o in kept):
                    kept.append(r)
            want |= set(kept)
    out = B.suppressed(df, ["image", "typ"], 0.4, ["x1", "y1", "x2", "y2", "k"])
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} == want and 10 < len(want) < len(rows)
    grown = B.scaled(df, 2.0).first()
    first = df.first()
    assert grown.x2 - grown.x1 == 2 * (first.x2 - first.x1) and grown.x1 + grown.x2 == first.x1 + first.x2


def test_detect_and_blur(spark):
    """Bright spots on faces are found, boxed, projected and blurred; everything else stays."""
    a = {i: np.full((32, 64, 3), 0.3) + 0.01 * RNG(i).random((32, 64, 3)) for i in range(3)}
    a[1][14:18, 31:35] = 0.9  # ahead
    a[1][15:17, 15:17] = 0.95  # to the left
    frames = frame_rows(spark, a)
    slots = {"F": M.Slot("t-bright", M.box_finder, (("limit", 0.6),))}
    found = G.detections(G.cube_rows(frames, 16), slots, 16, {"F": 0.5})
    got = {(r.image, r.face): (r.x1, r.y1, r.x2, r.y2) for r in found.collect()}
    assert set(got) == {(1, "F"), (1, "L")}
    x1, y1, x2, y2 = got[1, "F"]
    assert x1 < 8 < x2 and y1 < 8 < y2
    assert G.detections(G.cube_rows(frames, 16), slots, 16, {"F": 0.99}).count() == 0
    for scope in ("roi", "full"):
        how = G.Blur(mask_threshold=0.3, mask_feather=1.0, sigma=2.0, scope=scope, pad=4, min_area=1, roi_threshold=0.1, least_contour=1.0)
        rows = {r.img: r for r in G.blurred(frames, found, 16, how, annotate=True).collect()}
        assert [(rows[i].face_boxes, rows[i].lp_boxes, rows[i].error) for i in range(3)] == [(0, 0, None), (2, 0, None), (0, 0, None)]
        out = np.array(rows[1].data).reshape(32, 64, 3)
        assert np.abs(out - a[1])[14:18, 31:35].max() > 0.02 and np.array_equal(out[:4], a[1][:4]) and out[14:18, 31:35].std() < a[1][12:20, 29:37].std()
        assert rows[0].data == a[0].ravel().tolist() and rows[2].drawn == a[2].ravel().tolist()
        drawn = np.array(rows[1].drawn).reshape(32, 64, 3)
        assert (np.abs(drawn - np.array(G.COLOURS["F"])).max(axis=2) < 1e-9).sum() > 10


@pytest.mark.parametrize("make, what", [
    (lambda: G.Blur(scope="x", sigma=0), "blur: out of range: sigma, scope"), (lambda: G.Blur(roi_threshold=0), "roi_threshold"), (lambda: G.Finish(fov=(70, 180)), "finish: out of range: fov"),
    (lambda: G.Finish(dilation=-1, levels=-1), "dilation, levels"), (lambda: G.Tiles(rows=0), "tiles: out of range: rows"), (lambda: G.Tiles(ratio=1.0, pad=-1), "ratio, pad")])
def test_parameters_are_checked(make, what):
    with pytest.raises(ValueError, match=what):
        make()


def test_region_masks_are_unions():
    masks = G.region_mask([("F", 2, 2, 6, 6), ("R", 0, 0, 8, 8)], 8, 16, 32)
    cube = np.zeros((6, 8, 8))
    cube[0, 2:6, 2:6] = 1
    assert np.allclose(masks[0], sphere.panorama_of(cube, 16, 32))
    a = RNG(4).random((16, 32, 3))
    how = G.Blur(mask_threshold=0, mask_feather=0, sigma=1.0, scope="full")
    m = np.maximum(masks[0], masks[1])[..., None]
    assert np.allclose(G.blurred_frame(a, masks, how), a * (1 - m) + K.convolve(a, kernel_of_sigma(1.0)) * m)


def _counting(path):
    def run(frames):
        with open(path, "a") as f:
            f.write("\n" * len(frames))
        return [np.array([[0.0, 0.0, 2.0, 2.0, 0.9]])] * len(frames)

    return run


def test_detectors_see_each_face_once(spark, tmp_path):
    frames = frame_rows(spark, {i: np.full((8, 16, 3), 0.5) for i in range(3)})
    slots = {typ: M.Slot(f"t-count-{typ}", _counting, (("path", str(tmp_path / typ)),)) for typ in ("F", "LP")}
    assert len(G.detections(G.cube_rows(frames, 4), slots, 4, {"F": 0.1, "LP": 0.1}).collect()) == 24
    assert [(tmp_path / typ).stat().st_size for typ in ("F", "LP")] == [12, 12]


def _refusing():
    def run(frames):
        raise RuntimeError("no weights")

    return run


def test_images_with_errors_are_not_given_out(spark):
    frames = frame_rows(spark, {1: np.full((8, 16, 3), 0.5)})
    found = G.detections(G.cube_rows(frames, 4), {"F": M.Slot("t-find", M.box_finder, (("limit", 0.4),)), "LP": M.Slot("t-refuse", _refusing)}, 4, {"F": 0.1, "LP": 0.1})
    assert found.where("error IS NOT NULL").count() == 4 and found.where("error IS NULL").count() == 4
    r = G.blurred(frames, found, 4).first()
    assert r.error == "RuntimeError: no weights" and not r.data


def test_anonymized(spark):
    a = {1: RNG(1).random((9, 12, 3)), 2: RNG(2).random((9, 12, 3))}
    boxes = spark.createDataFrame([(1, 2, 1, 8, 7, 0.9, "LP"), (1, 4, 3, 12, 9, 0.5, "F"), (1, 0, 0, 1, 5, 0.4, "LP"), (1, 3, 3, 3, 9, 0.3, "LP")], "image long, x1 int, y1 int, x2 int, y2 int, conf double, typ string")
    got = {r.img: np.array(r.data).reshape(9, 12, 3) for r in G.anonymized(frame_rows(spark, a), boxes, "pixelate", factor=3).collect()}
    want = a[1].copy()
    for x1, y1, x2, y2 in ((4, 3, 12, 9), (2, 1, 8, 7)):  # faces first, each on what is there so far
        part = want[y1:y2, x1:x2]
        small = scaling.resized(part, (y2 - y1) // 3, (x2 - x1) // 3, "area")
        for y in range(y2 - y1):
            for x in range(x2 - x1):
                want[y1 + y, x1 + x] = small[y * small.shape[0] // (y2 - y1), x * small.shape[1] // (x2 - x1)]
    assert np.allclose(got[1], want) and np.array_equal(got[2], a[2])
    soft = G.anonymized_frame(a[1], [(2, 1, 8, 7)], "soft", 0.5)
    assert np.allclose(soft[1:7, 2:8], K.convolve(a[1][1:7, 2:8], K.soft_kernel(6, 6, 0.5))) and np.array_equal(soft[7:], a[1][7:])
    with pytest.raises(ValueError, match="unknown mode"):
        G.anonymized_frame(a[1], [], "x")


def test_windows_cover_the_side():
    assert scaling.windows(2000, 2, 0.0, 30) == [(0, 1030), (970, 2000)] and scaling.windows(1000, 1, 0.5, 10) == [(0, 1000)]
    for n, parts, ratio, more in ((9, 3, 0.1, 1), (33, 3, 0.4, 0), (8, 4, 0.0, 9), (5, 5, 0.9, 2)):
        w = scaling.windows(n, parts, ratio, more)
        assert len({b - a for a, b in w}) == 1 and w[0][0] == 0 and w[-1][1] == n and {i for a, b in w for i in range(a, b)} == set(range(n))


def test_tiled_masks(spark):
    """Against one loop over tiles; a tile on which a model fails leaves its image without a mask."""
    a = {1: RNG(1).random((7, 17, 3)), 2: RNG(2).random((5, 8, 3))}
    whole, spots = M.Slot("t-spread", M.spread_brightness, (("reach", 1),)), M.Slot("t-spots", M.brightness_mask, (("sensitivity", 0.7),))
    for how in (G.Tiles(0, 0, 2, 3, 0.2, 1, 1, 2, 1), G.Tiles(6, 12, 1, 2, 0.0, 2, 0, 0, 0, square=False)):
        got = {r.img: np.array(r.data).reshape(r.h, r.w) for r in G.tiled_masks(frame_rows(spark, a), whole, spots, how).collect()}
        for i, v in a.items():
            if how.height:
                v = np.clip(scaling.resized(v, 6, 12, "lanczos"), 0, 1)
            h, w = v.shape[:2]
            grid = np.pad(v, ((0, -h % how.rows), (0, -w % how.cols), (0, 0)), "edge").mean(axis=2)
            mask = np.zeros(grid.shape)
            for y1, y2 in scaling.windows(grid.shape[0], how.rows, how.ratio, how.more_y):
                for x1, x2 in scaling.windows(grid.shape[1], how.cols, how.ratio, how.more_x):
                    for y in range(y1, y2):
                        for x in range(x1, x2):
                            near = grid[max(y1, y - 1) : min(y2, y + 2), max(x1, x - 1) : min(x2, x + 2)]
                            hot = near if how.dilation else grid[y : y + 1, x : x + 1]
                            mask[y, x] = max(mask[y, x], near.max(), float((hot >= 0.7).any()))
            mask = mask[:h, :w]
            side = max(h, w)
            want = np.zeros((side, side)) if how.square else mask
            if how.square:
                want[(side - h) // 2 : (side - h) // 2 + h, (side - w) // 2 : (side - w) // 2 + w] = mask
            assert np.allclose(got[i], want)
    rows = G.tiled_masks(frame_rows(spark, a), whole, M.Slot("t-refuse2", _refusing), G.Tiles(0, 0)).collect()
    assert {(r.img, r.error, r.h) for r in rows} == {(i, "RuntimeError: no weights", 0) for i in a}


def test_finished(spark):
    a = {i: RNG(i).random((12, 24, 3)) for i in range(4)}
    hole = np.zeros((6, 6), bool)
    hole[2:4, 2:4] = True
    how = G.Finish(top_feather=1, seam=2, seam_pad=3, seam_ramp=2, seam_sigma=0.5, levels=2, blur_radius=1)
    jobs = spark.createDataFrame([(0, 1, 2), (3, None, None)], "img long, sky long, mask long")
    rows = {r.img: np.array(r.data).reshape(r.h, r.w, r.c) for r in G.finished(jobs, frame_rows(spark, a), hole, K.fill_mean, how).collect()}
    assert np.allclose(rows[0], G.finished_frame(a[0], a[1], a[2][..., 0], K.fill_mean, hole, how))
    assert np.allclose(rows[3], G.finished_frame(a[3], None, None, K.fill_mean, hole, how)) and set(rows) == {0, 3}
    bad = spark.createDataFrame([(0, 9, 2), (1, 2, 9), (2, 1, None), (3, None, None)], "img long, sky long, mask long")
    with pytest.raises(ValueError) as e:
        G.finished(bad, frame_rows(spark, a), hole, K.fill_mean, how)
    assert sorted(str(e.value).split("\n")) == ["0: missing sky", "1: missing mask", "2: a sky and a mask go together"]
    loose = {r.img: r.error for r in G.finished(bad, frame_rows(spark, a), hole, K.fill_mean, how, strict=False).collect()}
    assert loose == {0: "missing sky", 1: "missing mask", 2: "a sky and a mask go together", 3: None}


def test_growing_lines(spark, tmp_path):
    """Appends, half lines, new files and restarts: every line once, with its place."""
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    src.mkdir()
    written = {}

    def append(name, text):
        with open(src / name, "ab") as f:
            f.write(text.encode())
        written[name] = written.get(name, "") + text

    def follow():
        tail.growing_lines(spark, str(src), "*.jsonl", part_bytes=7).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.schema(tail.SCHEMA).parquet(out).collect()
        got = sorted((r.file, r.start, r.value) for r in rows)
        want = []
        for name, text in written.items():
            at, data = 0, text.encode()
            while (end := data.find(b"\n", at)) >= 0:
                want.append((name, at, data[at:end].decode().rstrip("\r")))
                at = end + 1
        assert got == sorted(w for w in want if w[0].endswith(".jsonl"))

    append("a.jsonl", "one\ntwo é\n\nhalf")
    append("b.jsonl", "no end yet")
    append("c.txt", "other\n")
    follow()
    append("a.jsonl", " a line\r\nnext line that is longer than a part\n")
    append("d.jsonl", "x\n" * 20)
    follow()
    append("b.jsonl", "\n")
    follow()
    follow()
    append("a.jsonl", "\n\n")
    follow()
    assert tail._last_line_end.__doc__ and spark.read.parquet(out).count() == 28


def test_growing_events(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.jsonl").write_text(json.dumps({"ts": "2026-01-01T00:01:00Z", "stage": "mask", "status": "failure"}) + "\nnot json\n")
    tail.growing_events(spark, str(tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    rows = {r.stage: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert str(rows["mask"]["at"]) == "2026-01-01 00:01:00" and rows[None]._corrupt == "not json"


def test_run_states(spark, tmp_path):
    """Open, ended and lost runs, over batches; a late event opens a lost run again."""
    seen = []
    src = tmp_path / "in"
    src.mkdir()
    schema = "run_id string, event string, status string, at timestamp"

    def put(k, rows):
        pd.DataFrame(rows, columns=["run_id", "event", "status", "at"]).to_json(src / f"{k}.json", orient="records", lines=True)

    put(0, [("a", "run_start", "running", "2026-01-01T00:00:00Z"), ("b", "run_start", "running", "2026-01-01T00:00:00Z"), ("c", "run_start", "running", "2026-01-01T00:01:00Z")])
    put(1, [("a", "stage_end", "failure", "2026-01-01T00:05:00Z"), ("b", "run_end", "success", "2026-01-01T00:06:00Z"), (None, "x", "failure", "2026-01-01T00:06:00Z")])
    put(2, [("d", "run_start", "running", "2026-01-01T02:00:00Z")])
    put(3, [("d", "stage_end", "success", "2026-01-01T02:10:00Z")])
    put(4, [("c", "stage_end", "success", "2026-01-01T02:05:00Z")])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(str(src))
    for k in range(5):
        os.utime(src / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    states.run_states(stream).writeStream.outputMode("update").foreachBatch(
        lambda df, i: seen.extend((i, *tuple(r)) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    of = lambda run: [s[2:] for s in seen if s[1] == run]
    assert of("b") == [("open", 1, 0, "run_start"), ("success", 2, 0, "run_end")]
    assert of("a") == [("open", 1, 0, "run_start"), ("open", 2, 1, "stage_end"), ("lost", 2, 1, "stage_end")]
    assert of("c")[:2] == [("open", 1, 0, "run_start"), ("lost", 1, 0, "run_start")] and of("c")[2] == ("open", 2, 0, "stage_end")
    assert of("d")[:2] == [("open", 1, 0, "run_start"), ("open", 2, 0, "stage_end")]


def test_files_are_carried_out(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    for i in range(9):
        (src / f"d{i % 2}").mkdir(parents=True, exist_ok=True)
        (src / f"d{i % 2}" / f"{i}.bin").write_bytes(bytes([i]) * (i + 1))
    plan = spark.createDataFrame([(f"d{i % 2}/{i}.bin", f"s{i % 3}/x/{i}.BIN") for i in range(9)], "src string, dst string").repartition(3)
    for uri in (str(dst), f"file://{dst}"):
        how = {r.how for r in copies.carried_out(plan, str(src), uri).collect()}
        assert how == ({"linked"} if uri == str(dst) else {"kept"})
    assert sorted(p.name for p in dst.rglob("*") if p.is_file()) == [f"{i}.BIN" for i in range(9)]
    assert all((dst / f"s{i % 3}/x/{i}.BIN").read_bytes() == bytes([i]) * (i + 1) for i in range(9))
    with pytest.raises(ValueError, match="2 files go to y"):
        copies.carried_out(spark.createDataFrame([("d0/0.bin", "y"), ("d1/1.bin", "y")], "src string, dst string"), str(src), str(dst))
    with pytest.raises(Exception, match="missing.bin"):
        copies.carried_out(spark.createDataFrame([("missing.bin", "y")], "src string, dst string"), str(src), str(dst)).collect()
    assert not [p for p in dst.rglob("*.part")]


def test_shell_words(spark):
    words = ["", "plain", "a b", "it's", "$HOME `x` \"q\" \\", "semi;colon|pipe&", "tab\tline\nend'\\", "é中-_./", "\x01\x1b[0m", "*?[]{}()<>!#~^"]
    out = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(S.shell_word(F.col("w"))).collect()]
    for w, q in zip(words, out, strict=True):
        assert subprocess.run(["bash", "--norc", "--noprofile", "-c", f"printf %s {q}"], capture_output=True).stdout.decode() == w


def test_image_rows_come_back(spark, tmp_path):
    a = {i: RNG(i).integers(0, 256, (3, 4, 3)) / 255 for i in range(3)}
    rows = FR.as_bytes(frame_rows(spark, a), F.format_string("f%d.png", "img"))
    image_sink.write_images(rows, str(tmp_path / "o"))
    back = FR.from_bytes(image_sink.read_images(spark, str(tmp_path / "o")), F.regexp_extract("path", "f([0-9]+)", 1))
    assert {r.img: np.round(np.array(r.data), 9).tolist() for r in back.collect()} == {i: np.round(v.ravel(), 9).tolist() for i, v in a.items()}
