"""Image files: inventories, decoding, and writing rasters and PNG files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions.kernels import pieces
from .work import shared_path


def inventory(spark: SparkSession, folder: str, recursive: bool = True, pattern: str = "*", bmp: bool = False) -> DataFrame:
    """path, rel_path, length, modificationTime of the images below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(folder)
    root = F.regexp_replace(F.lit(folder.rstrip("/")), "^file:/*", "/")
    rel = F.substring(F.regexp_replace("path", "^file:/*", "/"), F.length(root) + 2, F.lit(1 << 30))
    return few_tasks(files.select("path", rel.alias("rel_path"), "length", "modificationTime").where(P.is_image(F.col("path"), bmp)))


def few_tasks(files: DataFrame) -> DataFrame:
    """Rows of many small files in a few tasks a core: Spark's readers give a handful of files to each."""
    return files.coalesce(4 * files.sparkSession.sparkContext.defaultParallelism)


def decode(spark: SparkSession, folder: str, on_error: str = "keep", recursive: bool = False) -> DataFrame:
    """Colour rasters (origin, height, width, nChannels, mode, data); unreadable files by ``on_error``.

    keep: a row with ok = false; skip: no row; error: the job fails.
    """
    rows = spark.read.format("image").option("dropInvalid", on_error == "skip").option("recursiveFileLookup", recursive).load(folder).select("image.*")
    ok = F.col("height") > 0
    if on_error == "error":
        rows = rows.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unreadable image: "), "origin")).cast("boolean")))
    return rows.withColumn("ok", ok)


def gray(rasters: DataFrame) -> DataFrame:
    """(origin, height, width, data): 8-bit luma of BGR or gray rasters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            out = []
            for d, n in zip(b["data"], b["nChannels"].to_pylist(), strict=True):
                a = np.frombuffer(d.as_py(), np.uint8).reshape(-1, n).astype(float)
                out.append((a[:, 0] if n < 3 else a[:, :3] @ (0.114, 0.587, 0.299)).round().astype(np.uint8).tobytes())
            yield pa.record_batch([b["origin"], b["height"], b["width"], pa.array(out, pa.binary())], names=["origin", "height", "width", "data"])

    return rasters.where("height > 0").select("origin", "height", "width", "nChannels", "data").mapInArrow(
        run, "origin string, height int, width int, data binary")


def png(data: bytes, h: int, w: int) -> bytes:
    """An 8-bit gray PNG."""
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.frombuffer(data, np.uint8).reshape(h, w)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def as_png(rasters: DataFrame) -> DataFrame:
    """(img, png) of gray rasters (img, h, w, data); a table, which Spark's writers commit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            files = [png(d.as_py(), h, w) for d, h, w in zip(b["data"], b["h"].to_pylist(), b["w"].to_pylist(), strict=True)]
            yield pa.record_batch([b["img"], pa.array(files, pa.binary())], names=["img", "png"])

    return rasters.select("img", "h", "w", "data").mapInArrow(run, "img long, png binary")


def packed(px: DataFrame, h: int, w: int) -> DataFrame:
    """Gray rasters (img, h, w, data) of pixel relations (img, y, x, v in [0, 1]), truncated to bytes."""
    byte = F.lpad(F.hex(F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("v"))) * 255).cast("int")), 2, "0")
    s = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", byte.alias("b")))), lambda p: p["b"])
    return px.groupBy("img").agg(F.unhex(F.array_join(s, "")).alias("data")).select("img", F.lit(h).alias("h"), F.lit(w).alias("w"), "data")


#: Fixed values of the format: samples a pixel by colour type, at 8 bits.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfiltered(raw: np.ndarray, bpp: int) -> np.ndarray:
    """Rows without their filters: none, left, up, mean of both, or the nearest of left, up and corner."""
    out = np.zeros((len(raw) + 1, raw.shape[1] - 1 + bpp), np.uint8)  # a row and a pixel of zeros before
    for y, (kind, line) in enumerate(zip(raw[:, 0].tolist(), raw[:, 1:], strict=True), 1):
        if kind > 4:
            raise ValueError("unknown row filter")
        if kind in (0, 2):
            out[y, bpp:] = line + (out[y - 1, bpp:] if kind else 0)
            continue
        if kind == 1:
            out[y, bpp:] = np.cumsum(line.reshape(-1, bpp), axis=0, dtype=np.uint8).ravel()
            continue
        up, row = out[y - 1].tolist(), [0] * bpp
        for i, v in enumerate(line.tolist()):
            left, above, corner = row[i], up[i + bpp], up[i]
            if kind == 3:
                guess = (left + above) // 2
            else:
                p = left + above - corner
                guess = min((abs(p - left), 0, left), (abs(p - above), 1, above), (abs(p - corner), 2, corner))[2]
            row.append((v + guess) & 255)
        out[y] = row
    return out[1:, bpp:]


def gray_of_png(data: bytes) -> np.ndarray:
    """The 8-bit raster of a PNG of 8-bit samples: gray as it is, colours (also of a palette) as luma, without alpha.

    Other depths, interlaced rows and broken files are a ValueError.
    """
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    w, h, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", data[16:29])
    if depth != 8 or colour not in _SAMPLES or laced:
        raise ValueError("unsupported PNG")
    at, body, palette = 8, b"", b""
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        palette = data[at + 8 : at + 8 + n] if kind == b"PLTE" else palette
        at += n + 12
    bpp = _SAMPLES[colour]
    rows = _unfiltered(np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, w * bpp + 1), bpp)
    if colour in (0, 4):
        return np.ascontiguousarray(rows[:, ::bpp])
    if colour == 3:
        table = np.frombuffer(palette, np.uint8).reshape(-1, 3)
        if rows.size and rows.max() >= len(table):
            raise ValueError("colour beyond the palette")
        rgb = table[rows]
    else:
        rgb = rows.reshape(h, w, bpp)[..., :3]
    return (rgb.astype(float) @ (0.299, 0.587, 0.114)).round().astype(np.uint8)


def decoded(files: DataFrame) -> DataFrame:
    """(img, h, w, data, ok) of (img, png); what can't be read has ok = false and no data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            out = []
            for d in b["png"]:
                try:
                    a = gray_of_png(d.as_py())
                    out.append((a.shape[0], a.shape[1], a.tobytes(), True))
                except (ValueError, TypeError, struct.error, zlib.error):
                    out.append((-1, -1, None, False))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.bool_())
            yield pa.record_batch([b["img"], *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["img", "h", "w", "data", "ok"])

    return files.select("img", "png").mapInArrow(run, "img long, h int, w int, data binary, ok boolean")


def committed(rasters: DataFrame) -> DataFrame:
    """``rasters`` written as a table in the shared folder, by Spark's commit protocol, and read from it."""
    path = shared_path(rasters.sparkSession)
    rasters.write.parquet(path)
    return rasters.sparkSession.read.schema(rasters.schema).parquet(path)
