"""Outer contours of masks, and drawing: array kernels."""

from __future__ import annotations

import numpy as np

from .kernels import label

#: The eight neighbours (dy, dx), clockwise from the right (y points down).
AROUND = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))
#: Fixed glyphs, 5 wide and 7 high, a row as its bits.
GLYPHS = {
    "0": (14, 17, 19, 21, 25, 17, 14), "1": (4, 12, 4, 4, 4, 4, 14), "2": (14, 17, 1, 2, 4, 8, 31), "3": (31, 2, 4, 2, 1, 17, 14),
    "4": (2, 6, 10, 18, 31, 2, 2), "5": (31, 16, 30, 1, 1, 17, 14), "6": (6, 8, 16, 30, 17, 17, 14), "7": (31, 1, 2, 4, 8, 8, 8),
    "8": (14, 17, 17, 14, 17, 17, 14), "9": (14, 17, 17, 15, 1, 2, 12), ".": (0, 0, 0, 0, 0, 12, 12), "F": (31, 16, 16, 30, 16, 16, 16),
    "L": (16, 16, 16, 16, 16, 16, 31), "P": (30, 17, 17, 30, 16, 16, 16), " ": (0, 0, 0, 0, 0, 0, 0),
}


def traced(on: np.ndarray, y: int, x: int) -> list[tuple[int, int]]:
    """Border points (y, x) of the component whose topmost, then leftmost pixel is (y, x), clockwise from there.

    From each pixel the neighbours are tried clockwise, beginning behind the one it was reached
    from; the walk ends when it is about to repeat its first step.
    """
    h, w = on.shape
    out, at, came = [], (y, x), 4  # as if from the left, where nothing is
    first = None
    while True:
        for k in range(1, 9):
            way = (came + k) % 8
            ny, nx = at[0] + AROUND[way][0], at[1] + AROUND[way][1]
            if 0 <= ny < h and 0 <= nx < w and on[ny, nx]:
                break
        else:
            return [at]
        if (at, way) == first:
            return out
        first = first or (at, way)
        out.append(at)
        at, came = (ny, nx), (way + 4) % 8


def outer_contours(mask: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(label, border points) of each 8-connected component that isn't inside a hole of another, in order of the labels.

    A label is 1 + the flat place of the component's first pixel.
    """
    lab = label(mask)
    framed = np.pad(lab, 1)
    outside = np.zeros(framed.shape, bool)
    outside[0] = outside[-1] = outside[:, 0] = outside[:, -1] = True
    while True:  # what the frame reaches by sides, through what is off
        wider = outside.copy()
        wider[1:] |= outside[:-1]
        wider[:-1] |= outside[1:]
        wider[:, 1:] |= outside[:, :-1]
        wider[:, :-1] |= outside[:, 1:]
        wider &= framed == 0
        if (wider == outside).all():
            break
        outside = wider
    touch = np.zeros(framed.shape, bool)
    for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0)):
        touch |= np.roll(outside, (dy, dx), (0, 1))
    names = np.unique(framed[touch & (framed > 0)])
    return [(int(n), traced(lab == n, *divmod(int(n) - 1, mask.shape[1]))) for n in names]


def corner_places(points: list[tuple[int, int]]) -> list[int]:
    """Places of the points at which a closed contour turns; of fewer than three points all of them."""
    n = len(points)
    step = lambda i: (points[(i + 1) % n][0] - points[i % n][0], points[(i + 1) % n][1] - points[i % n][1])
    return [i for i in range(n) if n < 3 or step(i - 1) != step(i)]


def corners(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The points at which a closed contour turns; straight runs keep their ends only."""
    return [points[i] for i in corner_places(points)]


def enclosed(points: list[tuple[int, int]]) -> float:
    """The area of the polygon through the points."""
    y, x = np.array(points, float).T
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def stroke(h: int, w: int, points: list[tuple[int, int]], thickness: float) -> np.ndarray:
    """Pixels of an (h, w) frame whose centres lie within thickness / 2 of the closed polyline through the points."""
    on, r = np.zeros((h, w), bool), thickness / 2
    for (y0, x0), (y1, x1) in zip(points, points[1:] + points[:1], strict=True):
        top, left = max(0, int(min(y0, y1) - r)), max(0, int(min(x0, x1) - r))
        y, x = np.mgrid[top : min(h, int(max(y0, y1) + r) + 1), left : min(w, int(max(x0, x1) + r) + 1)]
        dy, dx = y1 - y0, x1 - x0
        t = np.clip(((y - y0) * dy + (x - x0) * dx) / max(dy * dy + dx * dx, 1), 0, 1)
        near = (y - y0 - t * dy) ** 2 + (x - x0 - t * dx) ** 2 <= r * r + 1e-9
        on[y[near], x[near]] = True
    return on


def text_mask(text: str) -> np.ndarray:
    """(7, 6 n - 1): the pixels of a line of text; unknown characters are blanks."""
    out = np.zeros((7, max(6 * len(text) - 1, 0)), bool)
    for i, c in enumerate(text):
        rows = np.array(GLYPHS.get(c, GLYPHS[" "]))
        out[:, 6 * i : 6 * i + 5] = rows[:, None] >> np.arange(4, -1, -1) & 1
    return out


def annotated(frame: np.ndarray, mask: np.ndarray, text: str, colour: tuple[float, ...], least_area: float = 0.0, thickness: float = 2.0) -> np.ndarray:
    """A copy of ``frame`` (h, w, c) with the outer contours of ``mask`` drawn, and ``text`` at the largest one's centroid.

    Contours that enclose less than ``least_area`` are left out; without any the frame stays.
    The label is a filled box of the colour with white text, moved into the frame as far as it fits.
    """
    h, w = frame.shape[:2]
    found = [p for _, p in outer_contours(mask) if enclosed(p) >= least_area]
    out = frame.copy()
    if not found:
        return out
    for points in found:
        out[stroke(h, w, points, thickness)] = colour
    main = max(found, key=lambda p: (enclosed(p), [-c for c in p[0]]))
    cy, cx = centroid(main)
    letters = np.pad(text_mask(text), 1)
    y0, x0 = (max(0, min(int(c + 1e-6), side - size)) for c, side, size in ((cy, h, letters.shape[0]), (cx, w, letters.shape[1])))
    box = out[y0 : y0 + letters.shape[0], x0 : x0 + letters.shape[1]]
    box[:] = colour
    box[letters[: box.shape[0], : box.shape[1]]] = 1.0
    return out


def centroid(points: list[tuple[int, int]]) -> tuple[float, float]:
    """(y, x) of the polygon's centre of mass; its first point if it has no area."""
    y, x = np.array(points, float).T
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    twice = cross.sum()
    if abs(twice) < 1e-12:
        return points[0]
    return float(((y + np.roll(y, -1)) * cross).sum() / (3 * twice)), float(((x + np.roll(x, -1)) * cross).sum() / (3 * twice))
