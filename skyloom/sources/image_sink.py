"""A sink of image files, one a row, as a Python data source: ``df.write.format("image_files")``.

Tasks write below a staging folder of the job; the commit of the job moves their files
to their places, so a failed task or job leaves none.  Only the driver makes the job's folder: once
an abort has deleted it, a task that still runs can't write any more.  Files are reached through
``pyarrow.fs``, so a path may be of any file system that it knows and all executors share.
"""

from __future__ import annotations

import contextlib
import os
import posixpath
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from ..functions import jpeg
from ..functions.kernels import pieces
from .images import few_tasks

#: Columns of the rows: a path below the folder, sides, channels (1, or 3: red, green, blue) and their bytes by row.
SCHEMA = "path string, height int, width int, channels int, data binary"
STAGING = "_staging"


def png(a: np.ndarray) -> bytes:
    """A PNG file of bytes (h, w) or (h, w, c): gray, gray and alpha, colour, colour and alpha."""
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    h, w = a.shape[:2]
    kind = {1: 0, 2: 4, 3: 2, 4: 6}[1 if a.ndim == 2 else a.shape[2]]
    rows = np.pad(a.reshape(h, -1), ((0, 0), (1, 0)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def file_of(path: str, a: np.ndarray, quality: int) -> bytes:
    """The file's bytes, by the ending of its path."""
    ending = path.lower().rpartition(".")[2]
    if ending in ("jpg", "jpeg"):
        return jpeg.encoded(a, quality)
    if ending == "png":
        return png(a)
    raise ValueError(f"can't write {path}: only .jpg, .jpeg and .png")


def located(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI or path, and the folder in it."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


@dataclass
class Written(WriterCommitMessage):
    """The staging folder of a task that has ended."""

    folder: str


class ImageFilesWriter(DataSourceWriter):
    def __init__(self, folder: str, quality: int, overwrite: bool):
        self.folder, self.quality, self.overwrite, self.job = folder, quality, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, root = located(self.folder)
        mine = f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(mine, recursive=False)
        made = set()
        for r in iterator:
            parts = (r.path or "").split("/")
            if not r.path or {"", ".", ".."} & set(parts) or parts[0] == STAGING:
                raise ValueError(f"not a path below the folder: {r.path}")
            a = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels)
            for k in range(1, len(parts)):
                at = "/".join(parts[:k])
                if at not in made:
                    fs.create_dir(f"{mine}/{at}", recursive=False)
                    made.add(at)
            with fs.open_output_stream(f"{mine}/{r.path}") as out:
                out.write(file_of(r.path, a, self.quality))
        return Written(mine)

    def _files(self, fs: pafs.FileSystem, folder: str) -> list[str]:
        return [f.path for f in fs.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True)) if f.type == pafs.FileType.File]

    def commit(self, messages: list[Written | None]) -> None:
        """One rename a file; running it again after a crash of the driver starts from new staging folders."""
        fs, root = located(self.folder)
        new, made = set(), set()
        for m in messages:
            for f in self._files(fs, m.folder) if m else []:
                to = f"{root}/{f[len(m.folder) + 1 :]}"
                if (at := posixpath.dirname(to)) not in made:
                    fs.create_dir(at)
                    made.add(at)
                fs.move(f, to)
                new.add(to)
        if self.overwrite:
            for f in self._files(fs, root):
                if f not in new and not f.startswith(f"{root}/{STAGING}/"):
                    fs.delete_file(f)
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*located(self.folder))

    def begin(self) -> None:
        """On the driver, before any task."""
        fs, root = located(self.folder)
        fs.create_dir(f"{root}/{STAGING}/{self.job}")

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        mine = f"{root}/{STAGING}/{self.job}"
        for _ in range(100):  # a task that still runs may put a file into a folder that is being deleted
            if fs.get_file_info(mine).type == pafs.FileType.NotFound:
                break
            try:
                fs.delete_dir(mine)
            except OSError:
                time.sleep(0.1)
        if isinstance(fs, pafs.LocalFileSystem):
            with contextlib.suppress(OSError):  # another job is at work
                os.rmdir(f"{root}/{STAGING}")


class ImageFiles(DataSource):
    """Options: path (the folder) and quality (of JPEG files, 85 unless given)."""

    @classmethod
    def name(cls) -> str:
        return "image_files"

    def writer(self, schema: StructType, overwrite: bool) -> ImageFilesWriter:
        if [(f.name, f.dataType.simpleString()) for f in schema] != [tuple(c.split(" ")) for c in SCHEMA.split(", ")]:
            raise ValueError(f"the columns must be {SCHEMA}")
        writer = ImageFilesWriter(self.options["path"].rstrip("/"), int(self.options.get("quality", 85)), overwrite)
        writer.begin()
        return writer


def write_images(images: DataFrame, folder: str, quality: int = 85, overwrite: bool = False) -> None:
    """Writes rows (path, height, width, channels, data) as files below ``folder``.

    A path that comes twice is an error, before anything is written.  Without ``overwrite`` files of
    other paths stay and those of the same paths are replaced, so a rerun gives the same folder.
    """
    rows = images.select("path", *[F.col(c).cast("int").alias(c) for c in ("height", "width", "channels")], "data")
    twice = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"{twice.n} images have the path {twice.path}")
    images.sparkSession.dataSource.register(ImageFiles)
    rows.write.format("image_files").option("path", folder).option("quality", quality).mode("overwrite" if overwrite else "append").save()


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, height, width, channels, data) of the files below a folder, by Spark's image reader; data as red, green, blue."""
    rows = few_tasks(spark.read.format("image").option("recursiveFileLookup", True).load(folder).select("image.*"))
    root = folder.removeprefix("file:").replace("//", "/").rstrip("/")
    path = F.substring(F.regexp_replace("origin", "^file:/*", "/"), len(root) + 2, 1 << 30)
    flipped = rows.select(path.alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data")
    return flipped.mapInArrow(_flipped, SCHEMA)


def _flipped(batches):
    import pyarrow as pa

    for b in pieces(batches):
        data = []
        for d, n in zip(b["data"], b["channels"].to_pylist(), strict=True):
            a = np.frombuffer(d.as_py(), np.uint8).reshape(-1, max(n, 1))
            data.append((a[:, [2, 1, 0, *range(3, n)]] if n > 2 else a).tobytes())
        yield pa.record_batch([*b.columns[:4], pa.array(data, pa.binary())], names=["path", "height", "width", "channels", "data"])
