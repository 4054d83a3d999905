"""Workflow files run on frames: a graph of image nodes becomes one function of an image's sources.

Only what a save node needs is kept, in topological order.  An image goes through the
graph in one task, without shuffles; a result that several nodes use is computed once
for it.  Model nodes are slots (``models.Slot``), loaded once in a worker.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scaling, sphere
from ..sources.workflows import WRAPPERS
from . import frames as FR
from .models import Slot

SAVE, LOAD = "Image Save", ("LoadImage", "Image Load", "LoadImageMask")
_CHANNELS = ("red", "green", "blue", "alpha")


def _mask(a: np.ndarray) -> np.ndarray:
    return a[..., 0] if a.ndim == 3 else a


def _composite(destination, source, x=0, y=0, resize_source=False, mask=None):
    """``source`` laid onto ``destination`` at (x, y), by its mask if there is one; what reaches beyond is cut."""
    h, w = destination.shape[:2]
    if resize_source:
        source = scaling.resized(source, h, w, "bilinear")
    weight = np.ones(source.shape[:2]) if mask is None else _mask(mask)
    if weight.shape != source.shape[:2]:
        weight = scaling.resized(weight, *source.shape[:2], "bilinear")
    top, left = max(0, y), max(0, x)
    bottom, right = min(h, y + source.shape[0]), min(w, x + source.shape[1])
    out = destination.copy()
    if bottom > top and right > left:
        part = slice(top - y, bottom - y), slice(left - x, right - x)
        k = weight[part][..., None]
        out[top:bottom, left:right] = out[top:bottom, left:right] * (1 - k) + source[part] * k
    return out


def _crop(image, width, height, x, y):
    x, y = min(x, image.shape[1] - 1), min(y, image.shape[0] - 1)
    return image[y : y + height, x : x + width]


def _resize(image, width, height, interpolation="bilinear", method="stretch", condition="always", multiple_of=0):
    h, w = scaling.target_size(*image.shape[:2], height, width, "keep" if method.startswith("keep") else method, condition, max(1, multiple_of))
    return image if (h, w) == image.shape[:2] else np.clip(scaling.resized(image, h, w, interpolation), 0, 1)


def _boxed(image, target_width, target_height, padding_color="black", interpolation="area"):
    """Resized in its shape into a box, and put in the middle of it."""
    h, w = scaling.target_size(*image.shape[:2], target_height, target_width)
    top, left = (target_height - h) // 2, (target_width - w) // 2
    out = np.full((target_height, target_width, image.shape[2]), float(padding_color == "white"))
    out[top : top + h, left : left + w] = np.clip(scaling.resized(image, h, w, interpolation), 0, 1)
    return out


def _empty(width, height, batch_size=1, color=0):
    return np.broadcast_to([(color >> s & 255) / 255 for s in (16, 8, 0)], (height, width, 3)).copy()


def _view(e_img, fov_deg_h, fov_deg_v, h_deg, v_deg, out_h, out_w, in_rot_deg=0, padding_mode="bilinear"):
    if in_rot_deg:
        raise ValueError("views that are rolled aren't supported")
    return sphere.view_of(e_img, (fov_deg_h, fov_deg_v), h_deg, v_deg, out_h, out_w)


#: What a class of node makes of its inputs, by their names; a tuple where it has several outputs.
KERNELS: dict[str, Callable[..., Any]] = {
    "EmptyImage": _empty, "ImageCrop": _crop, "ImageResize+": _resize, "ResizeAndPadImage": _boxed, "ImageCompositeMasked": _composite,
    "ImageToMask": lambda image, channel="red": image[..., min(_CHANNELS.index(channel), image.shape[2] - 1)],
    "MaskToImage": lambda mask: np.repeat(_mask(mask)[..., None], 3, axis=2), "InvertMask": lambda mask: 1 - mask,
    "FluxKontextImageScale": lambda image: scaling.scaled_to_preferred(image),
    "ImageTile": lambda image, columns, rows: np.tile(image, (rows, columns, 1)), "Equirectangular to Perspective": _view,
    "Perspective to Equirectangular": lambda perspective, equi_base, fov_w, fov_h, u_deg, v_deg, feather: sphere.patched(
        equi_base, perspective, (fov_w, fov_h), u_deg, v_deg, feather),
}


@dataclass(frozen=True)
class Step:
    """A node with its links (name: (node, output)) and its other inputs."""

    node: str
    kind: str
    links: tuple[tuple[str, tuple[str, int]], ...]
    values: tuple[tuple[str, Any], ...]


def compiled(workflow: str, models: dict[str, Slot] | None = None) -> list[Step]:
    """The live steps of a workflow text in an order in which links point back; what can't run is a ValueError.

    ``models`` names nodes, or classes of nodes, that a slot replaces: they run on their first linked image.
    """
    models = models or {}
    nodes = json.loads(workflow)
    for name in WRAPPERS:
        if isinstance(nodes, dict) and isinstance(nodes.get(name), dict):
            nodes = nodes[name]
            break
    if not isinstance(nodes, dict):
        raise ValueError("not a workflow")
    is_link = lambda v: isinstance(v, list) and len(v) == 2 and isinstance(v[0], str) and isinstance(v[1], int)
    done: dict[str, Step] = {}
    todo = [(n, False) for n in sorted(nodes, reverse=True) if isinstance(nodes[n], dict) and nodes[n].get("class_type") == SAVE]
    if not todo:
        raise ValueError(f"no {SAVE} node")
    open_: set[str] = set()
    while todo:
        name, ready = todo.pop()
        if name in done:
            continue
        if name not in nodes:
            raise ValueError(f"node {name} is missing")
        kind, inputs = nodes[name].get("class_type"), nodes[name].get("inputs", {})
        links = {k: (v[0], v[1]) for k, v in inputs.items() if is_link(v)}
        if name in models or kind in models:
            links = dict(list(links.items())[:1])
        elif kind not in KERNELS and kind not in (*LOAD, SAVE):
            raise ValueError(f"node {name}: no kernel or model for {kind}")
        if ready:
            open_.discard(name)
            done[name] = Step(name, kind, tuple(links.items()), tuple((k, v) for k, v in inputs.items() if not is_link(v)))
            continue
        if name in open_:
            raise ValueError(f"a cycle goes through node {name}")
        open_.add(name)
        todo.append((name, True))
        for to, _ in links.values():
            if to in open_:
                raise ValueError(f"a cycle goes through node {to}")
            todo.append((to, False))
    return list(done.values())


def evaluated(steps: list[Step], sources: dict[str, np.ndarray], models: dict[str, Slot]) -> dict[str, np.ndarray]:
    """The images that the save nodes get, by node; a result is dropped after its last use."""
    uses: dict[str, int] = {}
    for s in steps:
        for _, (to, _) in s.links:
            uses[to] = uses.get(to, 0) + 1
    held: dict[str, tuple] = {}
    saved = {}
    for s in steps:
        linked = {k: held[to][slot] for k, (to, slot) in s.links}
        slot = models.get(s.node) or models.get(s.kind)
        if slot:
            result, error = slot.results(list(linked.values()))[0]
            if error:
                raise ValueError(error)
        elif s.kind in LOAD:
            if s.node not in sources:
                raise ValueError(f"node {s.node} has no source")
            result = sources[s.node]
        elif s.kind == SAVE:
            saved[s.node] = next(iter(linked.values()))
            continue
        else:
            result = KERNELS[s.kind](**linked, **dict(s.values))
        held[s.node] = result if isinstance(result, tuple) else (result,)
        for _, (to, _) in s.links:
            uses[to] -= 1
            if not uses[to]:
                held.pop(to, None)
    return saved


def run(workflow: str, sources: dict[str, DataFrame], constants: dict[str, np.ndarray] | None = None, models: dict[str, Slot] | None = None) -> DataFrame:
    """(img, node, h, w, c, data, error): what the save nodes of ``workflow`` get, for every image.

    ``sources`` has the frames of load nodes, joined by image; ``constants`` those that are one image for
    all (a mask file), which go with the task and may have 64 MB.  An image on which a node fails
    gives one row with the error and no frame.
    """
    constants, models = constants or {}, models or {}
    if sum(a.nbytes for a in constants.values()) > 64 << 20:
        raise ValueError("constants have more than 64 MB")
    steps = compiled(workflow, models)
    wanted = {s.node for s in steps if s.kind in LOAD}
    names = sorted(wanted & sources.keys())
    if not names or wanted - sources.keys() - constants.keys():
        raise ValueError(f"load nodes without a source: {sorted(wanted - sources.keys() - constants.keys()) or 'all'}")
    joined = None
    for k, name in enumerate(names):
        mine = sources[name].select("img", *[F.col(c).alias(f"{c}_{k}") for c in FR.COLUMNS[1:]])
        joined = mine if joined is None else joined.join(mine, "img")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in FR.pieces(batches):
            inputs = [FR.arrays(b, f"_{k}") for k in range(len(names))]
            ids, nodes, images, errors = [], [], [], []
            for i, img in enumerate(b["img"].to_pylist()):
                try:
                    found = evaluated(steps, constants | {n: inputs[k][i] for k, n in enumerate(names)}, models)
                    rows = [(n, a, None) for n, a in sorted(found.items())]
                except Exception as e:  # noqa: BLE001  any failure of a node is a row
                    rows = [(None, np.empty((0, 0, 0)), f"{type(e).__name__}: {e}")]
                for n, a, e in rows:
                    ids.append(img)
                    nodes.append(n)
                    images.append(a)
                    errors.append(e)
            yield FR.batch_of(ids, images, {"node": pa.array(nodes, pa.string()), "error": pa.array(errors, pa.string())})

    return joined.mapInArrow(task, f"{FR.FRAME}, node string, error string").select("img", "node", *FR.COLUMNS[1:], "error")
