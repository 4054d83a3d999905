"""Array kernels for whole rasters: numpy in Arrow batches, one image a row.

They are the production form of ``skyloom.operators.raster`` and give the same
values; tests compare the two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def convolve(a: np.ndarray, kernel: list[tuple[int, float]]) -> np.ndarray:
    """Separable, mirrored edges: along x, then y."""
    if len(kernel) == 1:
        return a
    r = max(d for d, _ in kernel)
    for axis in (1, 0):
        n = a.shape[axis]
        index = np.arange(-r, n + r)
        m = np.mod(index, max(1, 2 * (n - 1)))
        padded = np.take(a, np.where(m < n, m, 2 * (n - 1) - m), axis=axis)
        a = sum(np.take(padded, np.arange(r + d, r + d + n), axis=axis) * k for d, k in kernel)
    return a


def extreme(a: np.ndarray, r: int, pick: Callable = np.maximum) -> np.ndarray:
    """Maximum (or minimum) over (2r+1) x (2r+1) within the raster."""
    for axis in (0, 1):
        out = a.copy()
        for d in range(1, r + 1):
            ahead = [slice(None)] * 2
            behind = [slice(None)] * 2
            ahead[axis], behind[axis] = slice(d, None), slice(None, -d)
            out[tuple(behind)] = pick(out[tuple(behind)], a[tuple(ahead)])
            out[tuple(ahead)] = pick(out[tuple(ahead)], a[tuple(behind)])
        a = out
    return a


def label(mask: np.ndarray) -> np.ndarray:
    """8-connected components; each pixel > 0 gets 1 + the least flat place of its component, others 0."""
    h, w = mask.shape
    out = np.where(mask > 0, np.arange(1, h * w + 1).reshape(h, w), np.iinfo(np.int64).max)
    on = mask > 0
    while True:
        low = np.where(on, extreme(out, 1, np.minimum), np.iinfo(np.int64).max)
        flat = np.append(low.ravel(), np.iinfo(np.int64).max)
        jump = np.where(on.ravel(), flat[np.where(on.ravel(), low.ravel() - 1, h * w)], low.ravel()).reshape(h, w)
        new = np.minimum(low, jump)
        if (new == out).all():
            return np.where(on, out, 0)
        out = new


def contour_centroids(mask: np.ndarray) -> list[tuple[int, float, float]]:
    """(label, x, y) of each component: the centroid of the polygon that its outer contour draws through pixel centres.

    Holes belong to the polygon.  Four neighbouring pixels of it fill the square between
    their centres, three the triangle, fewer nothing.  Polygons without area give the
    topmost, then leftmost pixel.
    """
    lab, out = label(mask), []
    for name in np.unique(lab[lab > 0]):
        y, x = np.nonzero(lab == name)
        top, left = y.min(), x.min()
        own = np.zeros((y.max() - top + 3, x.max() - left + 3), bool)
        own[y - top + 1, x - left + 1] = True
        outside = np.pad(np.zeros((own.shape[0] - 2, own.shape[1] - 2), bool), 1, constant_values=True)
        while True:
            wider = np.pad(outside, 1)
            wider = (wider[1:-1, 1:-1] | wider[:-2, 1:-1] | wider[2:, 1:-1] | wider[1:-1, :-2] | wider[1:-1, 2:]) & ~own
            if (wider == outside).all():
                break
            outside = wider
        solid = (~outside).astype(float)
        n = solid[:-1, :-1] + solid[:-1, 1:] + solid[1:, :-1] + solid[1:, 1:]
        area = (n == 4) + (n == 3) * 0.5
        total = area.sum()
        if not total:
            out.append((int(name), float(x[0]), float(y[0])))
            continue
        cy, cx = np.indices(n.shape) + np.array([top - 1, left - 1])[:, None, None]
        mean_x = cx + (solid[:-1, 1:] + solid[1:, 1:]) / np.maximum(n, 1)
        mean_y = cy + (solid[1:, :-1] + solid[1:, 1:]) / np.maximum(n, 1)
        out.append((int(name), float((area * mean_x).sum() / total), float((area * mean_y).sum() / total)))
    return out


#: Rows and bytes of rasters that a task holds as arrays at once.
PIECE_ROWS, PIECE_BYTES = 256, 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of so many rows and bytes at most, one row at least.

    What a task makes of a piece is given away before the next, so its memory doesn't grow with the table.
    """
    for b in batches:
        size = max(1, min(rows, b.num_rows * most // max(b.nbytes, 1)))
        for k in range(0, b.num_rows, size):
            yield b.slice(k, size)


def each_raster(kernel: Callable[[np.ndarray], np.ndarray]):
    """A mapInArrow function over (img, h, w, data: 64-bit floats) that applies ``kernel`` to each raster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            done = [
                kernel(np.frombuffer(d.as_py(), np.float64).reshape(h, w))
                for d, h, w in zip(b["data"], b["h"].to_pylist(), b["w"].to_pylist(), strict=True)
            ]
            yield pa.record_batch(
                [b["img"], pa.array([a.shape[0] for a in done], pa.int32()), pa.array([a.shape[1] for a in done], pa.int32()),
                 pa.array([np.ascontiguousarray(a, np.float64).tobytes() for a in done], pa.binary())],
                names=["img", "h", "w", "data"])

    return run


def halve(a: np.ndarray) -> np.ndarray:
    """The mean of each 2 x 2 block; an odd last row or column goes."""
    h, w = a.shape[0] // 2 * 2, a.shape[1] // 2 * 2
    return (a[:h:2, :w:2] + a[1:h:2, :w:2] + a[:h:2, 1:w:2] + a[1:h:2, 1:w:2]) / 4


def resize(a: np.ndarray, to_h: int, to_w: int) -> np.ndarray:
    """Bilinear, pixel centres at halves, clamped at the edges."""
    for axis, to in ((1, to_w), (0, to_h)):
        n = a.shape[axis]
        s = np.maximum(0.0, (np.arange(to) + 0.5) * (n / to) - 0.5)
        i = np.minimum(np.floor(s).astype(int), n - 1)
        f = np.expand_dims(s - i, 1 - axis)
        a = np.take(a, i, axis=axis) * (1 - f) + np.take(a, np.minimum(i + 1, n - 1), axis=axis) * f
    return a


def lanczos(a: np.ndarray, to_h: int, to_w: int, lobes: int = 4) -> np.ndarray:
    """Windowed sinc of 2 * ``lobes`` taps at the target's pixel centres, weights scaled to 1, clamped at the edges."""
    for axis, to in ((1, to_w), (0, to_h)):
        n = a.shape[axis]
        s = (np.arange(to) + 0.5) * (n / to) - 0.5
        at = np.floor(s).astype(int)[:, None] + np.arange(1 - lobes, lobes + 1)
        d = s[:, None] - at
        weight = np.where(np.abs(d) < lobes, np.sinc(d) * np.sinc(d / lobes), 0.0)
        weight /= weight.sum(axis=1, keepdims=True)
        taken = np.take(a, np.clip(at, 0, n - 1), axis=axis)  # the axis becomes (target, tap)
        a = np.einsum("yxt,xt->yx" if axis else "ytx,yt->yx", taken, weight)
    return a


def gaussian_pyramid(a: np.ndarray, kernel: list[tuple[int, float]], levels: int) -> list[np.ndarray]:
    """Finest first; stops at a side of 1."""
    out = [a]
    while len(out) <= levels and min(out[-1].shape[:2]) > 1:
        out.append(halve(convolve(out[-1], kernel)))
    return out


def laplacian_pyramid(a: np.ndarray, kernel: list[tuple[int, float]], levels: int) -> list[np.ndarray]:
    g = gaussian_pyramid(a, kernel, levels)
    return [fine - resize(coarse, *fine.shape) for fine, coarse in zip(g, g[1:], strict=False)] + g[-1:]


def collapse(pyramid: list[np.ndarray]) -> np.ndarray:
    out = pyramid[-1]
    for level in reversed(pyramid[:-1]):
        out = resize(out, *level.shape) + level
    return out


def laplacian_blend(base: np.ndarray, patch: np.ndarray, mask: np.ndarray, kernel: list[tuple[int, float]], levels: int) -> np.ndarray:
    """base * (1 - mask) + patch * mask, level by level; a mask and values in [0, 1].  A mask of zeros gives the base."""
    if not mask.any():
        return base
    parts = zip(laplacian_pyramid(base, kernel, levels), laplacian_pyramid(patch, kernel, levels), gaussian_pyramid(mask, kernel, levels), strict=True)
    return np.clip(collapse([p * m + b * (1 - m) for b, p, m in parts]), 0, 1)


def feather(mask: np.ndarray, f: int, kernel: list[tuple[int, float]]) -> np.ndarray:
    """Alpha of a hard mask: eroded by f, then blurred; f = 0 keeps it hard."""
    return convolve(extreme(mask, f, np.minimum), kernel) if f else mask


def seam_strip(w: int, seam: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, distances) of the strip around a panorama's seam, which lies before column 0.

    A column's distance is its number, counted on to the right of the seam and back to the left;
    the strip reaches ``seam + pad`` columns each way, but never around the whole panorama twice.
    """
    far = np.arange(max(-(seam + pad), -(w // 2)), min(seam + pad, w - w // 2))
    return far % w, far


def repaired_seam(
    a: np.ndarray, inpaint: Callable[[np.ndarray, np.ndarray], np.ndarray], seam: int = 40, pad: int = 128, ramp: int = 64, sigma: float = 3.0,
) -> np.ndarray:
    """A panorama (h, w, ...) whose columns within ``seam`` of where its ends meet are inpainted.

    ``inpaint`` gets the strip around the seam and the weight of what is to be filled (1 at the
    seam, blurred by ``sigma``); its result fades in over ``ramp`` columns from the strip's ends.
    """
    columns, far = seam_strip(a.shape[1], seam, pad)
    strip = a[:, columns]
    weight = ((far >= -seam) & (far < seam)).astype(float)[None].repeat(a.shape[0], axis=0)
    if sigma > 0:
        from ..operators.raster import kernel_of_sigma

        weight = convolve(weight, kernel_of_sigma(sigma))
    to_end = np.minimum(far - far[0], far[-1] - far)
    fade = (np.minimum(to_end / ramp, 1.0) if ramp else np.ones(len(far))).reshape((1, -1) + (1,) * (a.ndim - 2))
    out = a.copy()
    out[:, columns] += fade * (inpaint(strip, weight) - strip)
    return out


def each_embedding(side: int, kernel: Callable[[np.ndarray], list[np.ndarray]]):
    """A mapInArrow function over (img, e: side * side values in [-1, 1]) to pixels (level, img, y, x, v) of the kernel's rasters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            values = (b["e"].flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 1) / 2
            parts = []
            for img, a in zip(b["img"].to_pylist(), values.reshape(-1, side, side), strict=True):
                for level, out in enumerate(kernel(a)):
                    y, x = np.indices(out.shape).reshape(2, -1)
                    parts.append((np.full(out.size, level), np.full(out.size, img), y, x, out.ravel()))
            cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0)] * 5
            kinds = (np.int32, np.int64, np.int32, np.int32, np.float64)
            yield pa.record_batch([pa.array(c.astype(k)) for c, k in zip(cols, kinds, strict=True)], names=["level", "img", "y", "x", "v"])

    return run


def soft_kernel(h: int, w: int, share: float) -> list[tuple[int, float]]:
    """Gaussian of odd width, ``share`` of the shorter side and 3 at least, with the usual sigma for a width."""
    from ..operators.raster import kernel_of_feather

    k = max(3, int(min(h, w) * share))
    return kernel_of_feather((k if k % 2 else k + 1) // 2)


def roi_blur(a: np.ndarray, mask: np.ndarray, kernel: list[tuple[int, float]], pad: int, min_area: int) -> np.ndarray:
    """Each component of at least ``min_area`` is blurred in its padded box of the original, and only where it lies."""
    lab, out = label(mask), a.copy()
    for name in np.unique(lab[lab > 0]):
        own = lab == name
        if own.sum() < min_area:
            continue
        y, x = np.nonzero(own)
        box = slice(max(0, y.min() - pad), y.max() + 1 + pad), slice(max(0, x.min() - pad), x.max() + 1 + pad)
        out[box] = np.where(own[box], convolve(a[box], kernel), out[box])
    return out


def soft_region_blur(a: np.ndarray, mask: np.ndarray, kernel: list[tuple[int, float]], pad: int, min_area: int, threshold: float) -> np.ndarray:
    """A frame blurred around the components of ``mask`` >= ``threshold``, in order of their first pixels.

    The padded box of a component is blurred from the original and mixed, by the soft mask in all of
    the box, into what is there so far: where boxes overlap both count.
    """
    lab, out = label(mask >= threshold), a.copy()
    soft = mask.reshape(mask.shape + (1,) * (a.ndim - 2))
    for name in np.unique(lab[lab > 0]):
        y, x = np.nonzero(lab == name)
        if len(y) < min_area:
            continue
        box = slice(max(0, y.min() - pad), y.max() + 1 + pad), slice(max(0, x.min() - pad), x.max() + 1 + pad)
        out[box] = out[box] * (1 - soft[box]) + convolve(a[box], kernel) * soft[box]
    return out


def directions(face: str, n: int) -> np.ndarray:
    """Unit vectors (n, n, 3: right, up, forward) through the pixel centres of a cube face."""
    c = (np.arange(n) + 0.5) / n * 2 - 1
    u, v, one = np.broadcast_to(c, (n, n)), np.broadcast_to(-c[:, None], (n, n)), np.ones((n, n))
    xyz = {"F": (u, v, one), "R": (one, v, -u), "B": (-u, v, -one), "L": (-one, v, u), "U": (u, one, -v), "D": (u, -one, v)}[face]
    d = np.stack(xyz, axis=-1)
    return d / np.linalg.norm(d, axis=-1, keepdims=True)


def sample_equirect(a: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Bilinear samples of an equirectangular raster in directions ``d``; columns wrap, rows clamp."""
    h, w = a.shape
    x = (np.arctan2(d[..., 0], d[..., 2]) / (2 * np.pi) + 0.5) * w - 0.5
    y = np.clip((0.5 - np.arcsin(np.clip(d[..., 1], -1, 1)) / np.pi) * h - 0.5, 0, h - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    fx, fy, y1 = x - x0, y - y0, np.minimum(y0 + 1, h - 1)
    at = lambda yy, xx: a[yy, xx % w]
    return (at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y1, x0) * (1 - fx) + at(y1, x0 + 1) * fx) * fy


def equirect_to_cube(a: np.ndarray, n: int) -> np.ndarray:
    """Faces F, R, B, L, U, D below each other, (6n, n)."""
    return np.concatenate([sample_equirect(a, directions(f, n)) for f in "FRBLUD"])


def fill_mean(view: np.ndarray, hole: np.ndarray) -> np.ndarray:
    """Stands in for an inpainting model: by its weight the hole gets the mean of what has none."""
    hole = np.asarray(hole, float)
    rest = view[hole == 0]
    mean = rest.mean(axis=0) if len(rest) else np.zeros(view.shape[2:])
    weight = hole.reshape(hole.shape + (1,) * (view.ndim - 2))
    return view * (1 - weight) + mean * weight
