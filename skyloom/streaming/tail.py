"""Files that grow, as a stream: a Python data source that goes on where it stopped in each file.

Spark's own file source tracks files, so what is appended to one that was read already is
never seen.  ``growing_lines`` tracks bytes: an offset holds, for each file, where its last whole line
ends.  A line that isn't finished yet is left for later, so every line comes once, whatever the
moments at which writers append.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..sources.image_sink import located
from ..sources.records import EVENT_SCHEMA

SCHEMA = "file string, start long, value string"
#: Bytes of one task, and of one look back for the end of a line.
PART_BYTES, LOOK_BYTES = 16 << 20, 1 << 16


@dataclass
class Lines(InputPartition):
    """The lines of a file that begin in [start, end); ``first``: a line begins at ``start``."""

    path: str
    start: int
    end: int
    first: bool


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, folder: str, pattern: str, part_bytes: int):
        self.folder, self.pattern, self.part_bytes = folder, pattern, part_bytes

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        fs, root = located(self.folder)
        files = {}
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = f.path[len(root) + 1 :]
            if f.type == pafs.FileType.File and fnmatch.fnmatch(name, self.pattern):
                end = _last_line_end(fs, f.path, f.size)
                if end:
                    files[name] = end
        return {"files": files}

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        out = []
        for name, stop in sorted(end["files"].items()):
            begin = start["files"].get(name, 0)
            for at in range(begin, stop, self.part_bytes):
                out.append(Lines(name, at, min(at + self.part_bytes, stop), at == begin))
        return out

    def read(self, partition: Lines) -> Iterator[tuple]:
        fs, root = located(self.folder)
        with fs.open_input_file(f"{root}/{partition.path}") as f:
            at = partition.start
            if not partition.first:  # the line that runs into the part belongs to the one before
                f.seek(at - 1)
                at += len(_line(f)) - 1
            f.seek(at)
            while at < partition.end:
                line = _line(f)
                yield partition.path, at, line.rstrip(b"\r\n").decode(errors="replace")
                at += len(line)

    def commit(self, end: dict) -> None:
        """Nothing to clean up: files belong to their writers."""


def _line(f) -> bytes:
    """The bytes up to the next end of a line, with it."""
    parts = []
    while True:
        at = f.tell()
        some = f.read(4096)
        cut = some.find(b"\n")
        if cut >= 0:
            f.seek(at + cut + 1)
            return b"".join([*parts, some[: cut + 1]])
        parts.append(some)
        if not some:
            return b"".join(parts)


def _last_line_end(fs: pafs.FileSystem, path: str, size: int) -> int:
    """Where the last whole line of the first ``size`` bytes ends; 0 if there is none."""
    with fs.open_input_file(path) as f:
        end = size
        while end > 0:
            start = max(0, end - LOOK_BYTES)
            f.seek(start)
            cut = f.read(end - start).rfind(b"\n")
            if cut >= 0:
                return start + cut + 1
            end = start
    return 0


class GrowingLines(DataSource):
    """Options: path (a folder), pattern (of names below it, * by default), part_bytes."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> GrowingLinesReader:
        return GrowingLinesReader(self.options["path"].rstrip("/"), self.options.get("pattern", "*"), int(self.options.get("part_bytes", PART_BYTES)))


def growing_lines(spark: SparkSession, folder: str, pattern: str = "*", part_bytes: int = PART_BYTES) -> DataFrame:
    """A stream of (file, start, value): the lines of the files below a folder, as they are appended."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").option("path", folder).option("pattern", pattern).option("part_bytes", part_bytes).load()


def growing_events(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """Run events from growing files, as ``events.event_stream`` gives them: with ``at``, and unreadable lines in _corrupt."""
    lines = growing_lines(spark, folder, pattern)
    parsed = lines.select(F.from_json("value", EVENT_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}).alias("e")).select("e.*")
    return parsed.withColumn("at", F.try_to_timestamp("ts", F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
