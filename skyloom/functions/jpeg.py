"""A baseline JPEG encoder: cosine transform of 8 x 8 blocks, quantised by a quality, with codes fitted to the image.

Blocks are transformed and turned into symbols as whole arrays; only the code tables are
made symbol by symbol.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: Fixed values of the format: quantisation of brightness and of colour at quality 50.
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99)
CHROMA = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99)
#: Fixed weights of red, green and blue in brightness.
WEIGHTS = (0.299, 0.587, 0.114)
#: Places of a block along its diagonals, turning at the edges.
ZIGZAG = np.array([8 * i + j for i, j in sorted(
    ((i, j) for i in range(8) for j in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))])
_COS = np.array([[np.sqrt((1 if k else 0.5) / 4) * np.cos((2 * n + 1) * k * np.pi / 16) for n in range(8)] for k in range(8)])
#: Symbols that are turned into bits at once.
_PART = 1 << 18


def steps(quality: int, base: tuple[int, ...]) -> np.ndarray:
    """Quantisation steps (8, 8) of a quality from 1 to 100."""
    if not 1 <= quality <= 100:
        raise ValueError("quality goes from 1 to 100")
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(base) * scale + 50) // 100, 1, 255).reshape(8, 8)


def ycc(rgb: np.ndarray) -> list[np.ndarray]:
    """Brightness and the two colour differences, in [0, 255]."""
    r, g, b = (rgb[..., k].astype(float) for k in range(3))
    y = WEIGHTS[0] * r + WEIGHTS[1] * g + WEIGHTS[2] * b
    return [y, (b - y) / (2 - 2 * WEIGHTS[2]) + 128, (r - y) / (2 - 2 * WEIGHTS[0]) + 128]


def _grown(a: np.ndarray, side: int) -> np.ndarray:
    """To multiples of ``side``, by copies of the last row and column."""
    return np.pad(a, ((0, -a.shape[0] % side), (0, -a.shape[1] % side)), "edge")


def _quantised(a: np.ndarray, q: np.ndarray, unit: int) -> np.ndarray:
    """(units, unit * unit, 64): whole coefficients, in the order of the file; a unit holds unit x unit blocks."""
    h, w = a.shape[0] // 8, a.shape[1] // 8
    blocks = (a - 128).reshape(h, 8, w, 8).transpose(0, 2, 1, 3)
    c = np.rint(_COS @ blocks @ _COS.T / q).astype(np.int64).reshape(h, w, 64)[..., ZIGZAG]
    return c.reshape(h // unit, unit, w // unit, unit, 64).transpose(0, 2, 1, 3, 4).reshape(-1, unit * unit, 64)


def _size(v: np.ndarray) -> np.ndarray:
    """Bits of the absolute value."""
    return np.where(v == 0, 0, np.floor(np.log2(np.maximum(np.abs(v), 1))).astype(np.int64) + 1)


def _extra(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits behind a symbol: the value, or for a negative one the value less 1, in its lowest bits."""
    return np.where(v < 0, v + (1 << size) - 1, v)


def code_lengths(counts: dict[int, int]) -> list[tuple[int, int]]:
    """(symbol, bits) of a prefix code of at most 16 bits, from frequent to rare; the code of all ones stays free."""
    heap = [(n, s, (s,)) for s, n in counts.items()] + [(0, 256, (256,))]  # 256 gets the longest code, all ones
    heapq.heapify(heap)
    depth = dict.fromkeys([*counts, 256], 0)
    while len(heap) > 1:
        n, s, a = heapq.heappop(heap)
        m, _, b = heapq.heappop(heap)
        for x in a + b:
            depth[x] += 1
        heapq.heappush(heap, (n + m, s, a + b))
    of = [0] * (max(depth.values()) + 1)
    for bits in depth.values():
        of[bits] += 1
    for bits in range(len(of) - 1, 16, -1):
        while of[bits]:  # two of the longest go: one takes their parent's place, one shares the place of a shorter code
            short = next(k for k in range(bits - 2, 0, -1) if of[k])
            of[bits] -= 2
            of[bits - 1] += 1
            of[short + 1] += 2
            of[short] -= 1
    of[max(k for k, n in enumerate(of) if n)] -= 1
    lengths = [bits for bits, n in enumerate(of) for _ in range(n)]
    return list(zip(sorted(counts, key=lambda s: (-counts[s], s)), lengths, strict=True))


def _codes(lengths: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(code, bits) by symbol: codes count up within a length and double between lengths."""
    code, bits = np.zeros(256, np.int64), np.zeros(256, np.int64)
    at = before = 0
    for s, n in lengths:
        at <<= n - before
        code[s], bits[s], before = at, n, n
        at += 1
    return code, bits


def _packed(value: np.ndarray, bits: np.ndarray) -> bytes:
    """The lowest ``bits`` of each value, one after the other, filled up with ones."""
    out = []
    for k in range(0, len(value), _PART):
        v, n = value[k : k + _PART], bits[k : k + _PART]
        last = np.repeat(np.cumsum(n), n)
        out.append(((np.repeat(v, n) >> (last - 1 - np.arange(n.sum()))) & 1).astype(np.uint8))
    flat = np.concatenate(out)
    return np.packbits(np.concatenate([flat, np.ones(-len(flat) % 8, np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00")


def _segment(mark: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body


def encoded(a: np.ndarray, quality: int = 85, halved: bool = True) -> bytes:
    """A JPEG file of bytes (h, w), (h, w, 1) or (h, w, 3: red, green, blue); ``halved``: colour at half the size.

    Sides go up to 65,535.
    """
    if a.ndim == 3 and a.shape[2] == 1:
        a = a[..., 0]
    h, w = a.shape[:2]
    if a.dtype != np.uint8 or a.ndim not in (2, 3) or a.ndim == 3 and a.shape[2] != 3 or not 0 < h < 65536 or not 0 < w < 65536:
        raise ValueError("bytes of 1 or 3 channels are needed, sides from 1 to 65535")
    tables = [steps(quality, LUMA), steps(quality, CHROMA)]
    unit = 2 if halved and a.ndim == 3 else 1
    planes = [_grown(p, 8 * unit) for p in (ycc(a) if a.ndim == 3 else [a.astype(float)])]
    parts = [_quantised(planes[0], tables[0], unit)]
    for p in planes[1:]:
        small = p.reshape(p.shape[0] // unit, unit, p.shape[1] // unit, unit).mean(axis=(1, 3))
        parts.append(_quantised(small, tables[1], 1))
    for p in parts:
        p[..., 0] = np.diff(p[..., 0].ravel(), prepend=0).reshape(p.shape[:2])
    kind = np.concatenate([np.full(p.shape[1], min(k, 1)) for k, p in enumerate(parts)])
    c = np.concatenate(parts, axis=1)
    kind = np.tile(kind, len(c))
    c = c.reshape(-1, 64)

    block, place = np.nonzero(c[:, 1:])
    value, place = c[block, place + 1], place + 1
    same = np.concatenate([[False], block[1:] == block[:-1]]) if len(block) else np.empty(0, bool)
    run = place - np.where(same, np.concatenate([[0], place[:-1]]), 0)[: len(place)] - 1
    blanks = run // 16  # each stands for 16 zeros
    last = np.zeros(len(c), np.int64)
    last[block] = place  # places of a block rise
    ends, size, dc = np.nonzero(last < 63)[0], _size(value), c[:, 0]
    long = np.repeat(np.arange(len(block)), blanks)
    # (block, place, order), table (brightness or colour, and 2 more for all but the first coefficient), symbol, bits behind it
    rows = [
        (np.arange(len(c)), np.zeros(len(c), int), np.ones(len(c), int), kind, _size(dc), _extra(dc, _size(dc)), _size(dc)),
        (block[long], place[long], np.zeros(len(long), int), kind[block[long]] + 2, np.full(len(long), 0xF0), np.zeros(len(long), int), np.zeros(len(long), int)),
        (block, place, np.ones(len(block), int), kind[block] + 2, (run % 16) * 16 + size, _extra(value, size), size),
        (ends, np.full(len(ends), 64), np.ones(len(ends), int), kind[ends] + 2, np.zeros(len(ends), int), np.zeros(len(ends), int), np.zeros(len(ends), int))]
    at, where, order, table, symbol, extra, n_extra = (np.concatenate(x).astype(np.int64) for x in zip(*rows, strict=True))
    sort = np.lexsort((order, where, at))
    table, symbol, extra, n_extra = table[sort], symbol[sort], extra[sort], n_extra[sort]

    out = [b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
    n = len(parts)
    for k in range(min(n, 2)):
        out.append(_segment(0xDB, bytes([k]) + bytes(tables[k].ravel()[ZIGZAG].astype(np.uint8))))
    frame = b"".join(bytes([k + 1, unit * 17 if k == 0 else 17, min(k, 1)]) for k in range(n))
    out.append(_segment(0xC0, struct.pack(">BHHB", 8, h, w, n) + frame))
    code, bits = np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64)
    for t in np.unique(table).tolist():
        mine = table == t
        names, counts = np.unique(symbol[mine], return_counts=True)
        lengths = code_lengths(dict(zip(names.tolist(), counts.tolist(), strict=True)))
        by_length = [sum(b == k for _, b in lengths) for k in range(1, 17)]
        out.append(_segment(0xC4, bytes([t // 2 * 16 + t % 2, *by_length, *(s for s, _ in lengths)])))
        codes, sizes = _codes(lengths)
        code[mine], bits[mine] = codes[symbol[mine]], sizes[symbol[mine]]
    scan = b"".join(bytes([k + 1, min(k, 1) * 17]) for k in range(n))
    out.append(_segment(0xDA, bytes([n]) + scan + b"\0\x3f\0"))
    return b"".join([*out, _packed((code << n_extra) | extra, bits + n_extra), b"\xff\xd9"])
