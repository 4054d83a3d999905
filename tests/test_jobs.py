"""Jobs from folder to folder on small files: resumed work, unreadable files, missing partners, failing models."""

import os

import numpy as np
import pytest

from skyloom.functions import kernels as K
from skyloom.functions import scaling
from skyloom.operators import jobs as J
from skyloom.operators import models as M
from skyloom.operators import stages as G
from skyloom.sources import image_sink as S

RNG = np.random.default_rng
HOW = G.Blur(mask_threshold=0.3, mask_feather=0.5, sigma=1.0, pad=1, min_area=1, roi_threshold=0.1, least_contour=1.0)


def put(folder, images):
    for name, a in images.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(a if isinstance(a, bytes) else S.png(a))


def got(spark, folder):
    return {r.path: np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels) for r in S.read_images(spark, str(folder)).collect()}


def names(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs)


def spot():
    a = np.full((16, 32, 3), 60, np.uint8)
    a[7:9, 15:17] = 250
    return a


def test_blur_folder(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    plain = np.full((16, 32, 3), 60, np.uint8)
    put(src, {"a.png": spot(), "d/b.PNG": plain, "d/broken.png": b"\x89PNG\r\n\x1a\nnothing", "d/notes.txt": b"x"})
    slots = {"F": M.Slot("j-bright", M.box_finder, (("limit", 0.5),))}
    run = lambda **k: {r.image: r for r in J.blur_folder(spark, str(src), str(out), slots, 8, {"F": 0.1}, HOW, **k).collect()}
    rows = run()
    assert {(i, r.face_boxes, r.total_boxes, r.blur_output, r.annot_output, r.error) for i, r in rows.items()} == {
        ("a.png", 1, 1, "a_blur.jpg", "a_annot.jpg", None), ("d/b.PNG", 0, 0, "d/b_blur.jpg", "d/b_annot.jpg", None), ("d/broken.png", 0, 0, "", "", "unreadable")}
    assert names(out) == ["a_annot.jpg", "a_blur.jpg", "d/b_annot.jpg", "d/b_blur.jpg"]
    seen = got(spark, out)
    assert seen["a_blur.jpg"][7:9, 15:17].max() < 240 and np.abs(seen["d/b_blur.jpg"].astype(int) - 60).max() <= 2
    assert set(run()) == {"d/broken.png"}  # only what has no files yet
    os.remove(out / "a_annot.jpg")
    assert set(run()) == {"a.png", "d/broken.png"} and len(names(out)) == 4
    assert set(run(annotate=False)) == {"d/broken.png"} and set(run(overwrite=True)) == {"a.png", "d/b.PNG", "d/broken.png"}


def test_a_job_without_files_decodes_none(spark, tmp_path, monkeypatch):
    src = tmp_path / "src"
    monkeypatch.setattr(J.S, "read_images", lambda *a: pytest.fail("files are decoded"))
    src.mkdir()
    slots = {"F": M.Slot("j-bright", M.box_finder, (("limit", 0.6),))}
    rows = J.blur_folder(spark, str(src), str(tmp_path / "out"), slots, 8, {"F": 0.1}, HOW)
    assert rows.collect() == [] and rows.columns[0] == "image"


def test_blur_folder_with_a_failing_model(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    put(src, {"a.png": spot()})

    def load():
        raise RuntimeError("no weights")

    slots = {"F": M.Slot("j-load", lambda: (lambda frames: (_ for _ in ()).throw(RuntimeError("refused"))))}
    rows = J.blur_folder(spark, str(src), str(out), slots, 8, {"F": 0.1}, HOW).collect()
    assert [(r.image, r.blur_output, r.error) for r in rows] == [("a.png", "", "RuntimeError: refused")] and not out.exists()
    with pytest.raises(Exception, match="no weights"):  # a model that can't be loaded is no row
        J.blur_folder(spark, str(src), str(out), {"F": M.Slot("j-none", load)}, 8, {"F": 0.1}, HOW).collect()


def test_mask_folder(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    a = RNG(1).integers(0, 256, (6, 10, 3)).astype(np.uint8)
    put(src, {"a.jpg": S.file_of("a.jpg", a, 95), "a.png": a, "d/b.png": a[:4]})
    whole, spots = M.Slot("j-spread", M.spread_brightness, (("reach", 0),)), M.Slot("j-spots", M.brightness_mask, (("sensitivity", 2.0),))
    how = G.Tiles(0, 0, 1, 2, 0.0, 1, 0, 0, 0, square=False)
    rows = J.mask_folder(spark, str(src), str(out), whole, spots, how).collect()
    assert {(r.image, r.output, r.error) for r in rows} == {("a.jpg", "a.png", None), ("d/b.png", "d/b.png", None)}
    assert np.abs(got(spark, out)["d/b.png"][..., 0] - a[:4].mean(axis=2)).max() <= 1
    assert J.mask_folder(spark, str(src), str(out), whole, spots, how).collect() == []


def test_finish_folder(spark, tmp_path):
    src, masks, out = tmp_path / "in", tmp_path / "masks", tmp_path / "out"
    a = {k: RNG(k).integers(0, 256, (12, 24, 3)).astype(np.uint8) for k in range(4)}
    hole = np.zeros((6, 6), bool)
    hole[2:4, 2:4] = True
    how = G.Finish(top_feather=1, seam=2, seam_pad=3, seam_ramp=2, seam_sigma=0.5, levels=2, blur_radius=1)
    put(src, {"d/x_comfyui_carremoved.PNG": a[0], "d/x_comfyui_newsky.png": a[1], "y_comfyui_carremoved.png": a[2], "other.png": a[3]})
    put(masks, {"d/x.png": a[3][..., 0]})
    run = lambda **k: J.finish_folder(spark, str(src), str(masks), str(out), hole, K.fill_mean, how, **k)
    with pytest.raises(ValueError, match="no new sky for y_comfyui_carremoved.png"):
        run()
    put(src, {"y_comfyui_newsky.jpg": S.file_of("y.jpg", a[1], 95)})
    with pytest.raises(ValueError, match="no mask for y_comfyui_carremoved.png"):
        run()
    assert not out.exists()
    put(masks, {"y.png": a[0][..., 0]})
    assert {(r.image, r.output) for r in run().collect()} == {("d/x_comfyui_carremoved.PNG", "d/x.png"), ("y_comfyui_carremoved.png", "y.png")}
    f = lambda k: a[k] / 255
    want = G.finished_frame(f(0), f(1), f(3)[..., 0], K.fill_mean, hole, how)
    assert np.abs(got(spark, out)["d/x.png"] - np.floor(want * 255 + 1e-9)).max() <= 1 and names(out) == ["d/x.png", "y.png"]
    os.remove(masks / "y.png")
    assert run().collect() == []  # done already: nothing is missing
    with pytest.raises(ValueError, match="no image of"):
        J.finish_folder(spark, str(masks), str(masks), str(out), hole, K.fill_mean, how)
    all_ = J.finish_folder(spark, str(masks / "d"), None, str(tmp_path / "rest"), np.zeros((6, 6), bool), K.fill_mean, how).collect()
    assert [(r.image, r.output) for r in all_] == [("x.png", "x.png")] and names(tmp_path / "rest") == ["x.png"]


def test_sizes_of_gray_files(spark, tmp_path):
    put(tmp_path, {"g.png": RNG(3).integers(0, 256, (5, 7)).astype(np.uint8)})
    r = S.read_images(spark, str(tmp_path)).first()
    assert (r.height, r.width) == (5, 7) and r.channels in (1, 3) and scaling.to_square(5, 7) == (1, 1, 0, 0)
