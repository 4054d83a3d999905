"""Sky replacement as one kernel: the mask is aligned, oriented and hardened, then two frames are blended by Laplacian pyramids."""

from __future__ import annotations

import numpy as np

from ..operators.raster import kernel_of_radius
from .kernels import convolve, extreme, gaussian_pyramid
from .scaling import resized

#: The blur between pyramid levels, the least byte that counts as sky.
LEVEL_BLUR, SKY_BYTE = 2, 127


def aligned(mask: np.ndarray, h: int, w: int) -> np.ndarray:
    """The middle of a mask that has the shape of (h, w), resized to it; sides are rounded half to even."""
    mh, mw = mask.shape
    if abs(mw / mh - w / h) > 1e-6:
        if mw / mh > w / h:
            side = round(mh * w / h)
            mask = mask[:, max(0, (mw - side) // 2) :][:, :side]
        else:
            side = round(mw * h / w)
            mask = mask[max(0, (mh - side) // 2) :][:side]
    return np.clip(resized(mask, h, w, "lanczos"), 0, 1)


def oriented(mask: np.ndarray) -> np.ndarray:
    """The mask, or its reverse if its lower third is brighter than its upper third."""
    third = mask.shape[0] // 3
    return 1 - mask if mask[: max(1, third)].mean() < mask[2 * mask.shape[0] // 3 :].mean() else mask


def blended(base: np.ndarray, sky: np.ndarray, mask: np.ndarray, levels: int) -> np.ndarray:
    """base * (1 - mask) + sky * mask on every level of the pyramids, put together again; frames (h, w, c), a mask (h, w)."""
    kernel = kernel_of_radius(LEVEL_BLUR)
    a, b, m = (gaussian_pyramid(x, kernel, levels) for x in (base, sky, mask[..., None]))
    out = a[-1] * (1 - m[-1]) + b[-1] * m[-1]
    for k in range(len(a) - 2, -1, -1):
        fine_a, fine_b = (p[k] - resized(p[k + 1], *p[k].shape[:2]) for p in (a, b))
        out = resized(out, *a[k].shape[:2]) + fine_a * (1 - m[k]) + fine_b * m[k]
    return np.clip(out, 0, 1)


def replaced(base: np.ndarray, sky: np.ndarray, mask: np.ndarray, dilation: int = 0, radius: float = 0, levels: int = 4) -> np.ndarray:
    """``base`` with the sky of ``sky`` where ``mask`` (h, w), of any size, shows it; a mask without sky gives the base.

    The hard mask grows by ``dilation`` pixels and is blurred by ``radius``.
    """
    h, w = base.shape[:2]
    if sky.shape[:2] != (h, w):
        sky = resized(sky, h, w, "lanczos")
    hard = (oriented(aligned(mask, h, w)) >= SKY_BYTE / 255 - 1e-9).astype(float)
    if not hard.any():
        return base
    soft = np.clip(convolve(extreme(hard, dilation) if dilation else hard, kernel_of_radius(radius)), 0, 1)
    return blended(base, sky, soft, levels)
