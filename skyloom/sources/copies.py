"""File plans carried out: links or copies of (src, dst), by tasks, on file systems that all executors share."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .image_sink import located


def _carried(source: str, target: str, src: str, dst: str, strict: bool) -> str:
    (fs, root), (to_fs, to_root) = located(source), located(target)
    a, b = f"{root}/{src}", f"{to_root}/{dst}"
    have, there = fs.get_file_info(a), to_fs.get_file_info(b)
    if have.type != pafs.FileType.File:
        raise FileNotFoundError(a)
    if there.type == pafs.FileType.File and there.size == have.size and there.mtime_ns >= have.mtime_ns:
        return "kept"
    to_fs.create_dir(posixpath.dirname(b))
    part, how = f"{b}.{uuid.uuid4().hex}.part", "copied"
    local = isinstance(fs, pafs.LocalFileSystem) and isinstance(to_fs, pafs.LocalFileSystem)
    try:
        if local:
            try:
                os.link(a, part)
                how = "linked"
            except OSError:
                if strict:
                    raise
        elif strict:
            raise OSError(f"no hard links between {source} and {target}")
        if how == "copied":
            pafs.copy_files(a, part, source_filesystem=fs, destination_filesystem=to_fs)
        to_fs.move(part, b)
    finally:
        if to_fs.get_file_info(part).type == pafs.FileType.File:
            to_fs.delete_file(part)
    return how


def carried_out(plan: DataFrame, source: str, target: str, strict: bool = False) -> DataFrame:
    """(src, dst, how): each file ``src`` below ``source`` put at ``dst`` below ``target``; how: linked, copied or kept.

    A hard link where the file system has them, else a copy (``strict``: an error).  A file appears whole, by
    a rename; one that is there already, as large and not older, is kept, so a plan can be run again after a
    failure, and twice at once.  Two sources for one place are an error, before anything is written.
    The result is lazy: files are written when it is.
    """
    twice = plan.groupBy("dst").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"{twice.n} files go to {twice.dst}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            how = [_carried(source, target, s, d, strict) for s, d in zip(b["src"].to_pylist(), b["dst"].to_pylist(), strict=True)]
            yield pa.record_batch([b["src"], b["dst"], pa.array(how, pa.string())], names=["src", "dst", "how"])

    return plan.select("src", "dst").mapInArrow(run, "src string, dst string, how string")
