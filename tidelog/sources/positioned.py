"""A text log with places: a data source of lines with their file and end offset, batch and streaming.

A log is a folder of files that are only appended to. Files are ordered by the number at the end
of their name, so the log is one sequence of bytes and one (file, offset) says how far it was read. A
batch read cuts files into byte ranges; a line belongs to the range its first byte lies in, and a task reads
several small ranges, so a log of many small files is not a task for each. A stream's offsets are places in the log: new files and new lines of the last file are both
found, a line that is still being written is left for later, and nothing is listed per file in the checkpoint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual)

from .change_log import parse_change_log

SCHEMA = "log_file STRING, file_no BIGINT, position BIGINT, json STRING"
RANGE_BYTES = 64 << 20
# What one task reads, and what opening a range counts for.
TASK_BYTES, OPEN_BYTES = 64 << 20, 256 << 10
CHUNK, ROWS = 1 << 20, 2048
EARLIEST, LATEST = "earliest", "latest"


@dataclass(frozen=True)
class LogFile:
    number: int
    name: str
    path: str
    size: int


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))
    return pafs.LocalFileSystem(), folder


def list_files(folder: str) -> list[LogFile]:
    """The log's files in order. A file is named by itself, or by a folder ``log_file=NAME`` that holds only it."""
    fs, base = filesystem(folder)
    found: dict[str, LogFile] = {}
    for info in fs.get_file_info(pafs.FileSelector(base, recursive=True)):
        inside = info.path[len(base):].strip("/")
        if info.type != pafs.FileType.File or any(part[0] in "._" for part in inside.split("/")):
            continue
        above = re.search(r"(?:^|/)log_file=([^/]+)/[^/]+$", inside)
        name = above[1] if above else inside.rsplit("/", 1)[-1]
        number = re.search(r"(\d+)(?:\.\w*[a-zA-Z]\w*)?$", name)
        if number is None:
            raise ValueError(f"log file {name} has no number, so its place in the log is unknown")
        if name in found:
            raise ValueError(f"log file {name} is there twice: {found[name].path} and {info.path}")
        found[name] = LogFile(int(number[1]), name, info.path, info.size)
    stems = {re.sub(r"\d+(?:\.\w*[a-zA-Z]\w*)?$", "", name) for name in found}
    if len(stems) > 1:
        raise ValueError(f"files of several logs in {folder}: {', '.join(sorted(stems))}")
    return sorted(found.values(), key=lambda f: (f.number, f.name))


def last_line_end(fs: pafs.FileSystem, file: LogFile) -> int:
    """Offset behind the last line that is complete."""
    with fs.open_input_file(file.path) as stream:
        at = file.size
        while at > 0:
            begin = max(0, at - CHUNK)
            found = stream.read_at(at - begin, begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            at = begin
    return 0


@dataclass
class ByteRange(InputPartition):
    """Lines of ``path`` whose first byte is in [start, stop); only those that end by ``limit``."""

    file: LogFile
    start: int
    stop: int
    limit: int

    def __init__(self, file: LogFile, start: int, stop: int, limit: int):
        self.file, self.start, self.stop, self.limit = file, start, stop, limit


@dataclass
class Ranges(InputPartition):
    """Neighbouring byte ranges that one task reads."""

    parts: list[ByteRange]

    def __init__(self, parts: list[ByteRange]):
        self.parts = parts


def pack(ranges: list[ByteRange], tasks: int) -> list[Ranges]:
    """Ranges dealt to at least ``tasks`` tasks, if there are as many, each of about TASK_BYTES at most; a larger range is a task of its own."""
    sizes = [OPEN_BYTES + r.stop - r.start for r in ranges]
    most = min(TASK_BYTES + OPEN_BYTES, sum(sizes) / max(1, tasks))
    out: list[Ranges] = []
    room = 0.0
    for part, size in zip(ranges, sizes):
        if size > room:
            out.append(Ranges([]))
            room = most
        out[-1].parts.append(part)
        room -= size
    return out


def cut(file: LogFile, start: int, limit: int, size: int) -> list[ByteRange]:
    return [ByteRange(file, at, min(at + size, limit), limit) for at in range(start, limit, size)]


def read_lines(folder: str, part: ByteRange) -> Iterator[pa.RecordBatch]:
    """Batches of (log_file, file_no, position, json); position is the offset behind the line. Blank lines are no events."""
    fs, _ = filesystem(folder)
    schema = pa.schema([("log_file", pa.string()), ("file_no", pa.int64()), ("position", pa.int64()), ("json", pa.string())])

    def batch(ends: list[int], lines: list[bytes]) -> pa.RecordBatch:
        texts = pa.array([line.rstrip(b"\r").decode("utf-8", "replace") for line in lines], pa.string())
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([part.file.name] * n, pa.string()), pa.array([part.file.number] * n, pa.int64()),
                                           pa.array(ends, pa.int64()), texts], schema=schema)

    with fs.open_input_file(part.file.path) as stream:
        # The byte before the range tells whether a line begins at its start.
        at = max(0, part.start - 1)
        rest, begin = b"", at
        skip = part.start > 0
        ends: list[int] = []
        lines: list[bytes] = []
        while begin < part.stop or rest:
            chunk = stream.read_at(min(CHUNK, part.limit - at), at) if at < part.limit else b""
            at += len(chunk)
            pieces = (rest + chunk).split(b"\n")
            rest = pieces.pop()
            if not chunk and rest:
                pieces.append(rest)
                rest = b""
                last_open = 1
            else:
                last_open = 0
            for k, line in enumerate(pieces):
                end = begin + len(line) + (0 if last_open and k == len(pieces) - 1 else 1)
                if skip:
                    skip = False
                elif begin < part.stop and line.strip():
                    ends.append(end)
                    lines.append(line)
                begin = end
                if begin >= part.stop:
                    rest = b""
                    break
            if len(lines) >= ROWS or not chunk or begin >= part.stop:
                if lines:
                    yield batch(ends, lines)
                ends, lines = [], []
            if not chunk or begin >= part.stop:
                return


def parse_start(text: str) -> tuple[int, str, int] | None:
    """(number, file, offset) of a two-line place; null for the words earliest and latest."""
    if text in (EARLIEST, LATEST):
        return None
    name, position = text.split()[:2]
    return int(re.search(r"(\d+)(?:\.\w*[a-zA-Z]\w*)?$", name)[1]), name, int(position)


class PositionedReader(DataSourceReader):
    """Byte ranges of the files that the start and pushed filters on file_no leave."""

    def __init__(self, folder: str, start: str, size: int, tasks: int):
        self.folder, self.start, self.size, self.tasks = folder, start, size, tasks
        self.low, self.high = None, None

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) == ("file_no",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(f.value + isinstance(f, GreaterThan), f.value if self.low is None else self.low)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(f.value - isinstance(f, LessThan), f.value if self.high is None else self.high)
            yield f  # files are pruned by it, rows are not

    def partitions(self):
        files = list_files(self.folder)
        if self.start == LATEST:
            return []
        mark = parse_start(self.start)
        out = []
        for f in files:
            if (self.low is not None and f.number < self.low) or (self.high is not None and f.number > self.high) or (mark and f.number < mark[0]):
                continue
            out += cut(f, mark[2] if mark and f.number == mark[0] else 0, f.size, self.size)
        return pack(out, self.tasks)

    def read(self, partition):
        # A read of nothing still has one partition, which is null.
        for part in partition.parts if partition else ():
            yield from read_lines(self.folder, part)


class PositionedStream(DataSourceStreamReader):
    """Offsets are ``{"no", "file", "at"}``: every earlier file is done, and ``file`` up to ``at``."""

    def __init__(self, folder: str, start: str, size: int, tasks: int):
        self.folder, self.start, self.size, self.tasks = folder, start, size, tasks

    def _end(self) -> dict:
        fs, _ = filesystem(self.folder)
        files = list_files(self.folder)
        # A file behind which another has begun is complete; of the last one only whole lines are.
        while files:
            at = last_line_end(fs, files[-1])
            if at or len(files) == 1:
                return {"no": files[-1].number, "file": files[-1].name, "at": at}
            files.pop()
        return {"no": -1, "file": "", "at": 0}

    def initialOffset(self):
        if self.start == LATEST:
            return self._end()
        mark = parse_start(self.start)
        return {"no": -1, "file": "", "at": 0} if mark is None else dict(zip(("no", "file", "at"), mark))

    def latestOffset(self):
        return self._end()

    def partitions(self, start, end):
        out = []
        for f in list_files(self.folder):
            if start["no"] <= f.number <= end["no"]:
                limit = end["at"] if f.number == end["no"] else f.size
                out += cut(f, start["at"] if f.number == start["no"] else 0, limit, self.size)
        return pack(out, self.tasks)

    def read(self, partition):
        for part in partition.parts:
            yield from read_lines(self.folder, part)

    def commit(self, end):
        pass


class PositionedLog(DataSource):
    """``spark.read`` or ``spark.readStream.format("positioned_log")`` with ``path``, ``start``, ``rangeBytes`` and ``tasks``."""

    @classmethod
    def name(cls) -> str:
        return "positioned_log"

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[str, str, int, int]:
        return (self.options["path"].rstrip("/"), self.options.get("start", EARLIEST), int(self.options.get("rangeBytes", RANGE_BYTES)),
                int(self.options.get("tasks", 1)))

    def reader(self, schema):
        return PositionedReader(*self._settings())

    def streamReader(self, schema):
        return PositionedStream(*self._settings())


def _options(spark: SparkSession, start: tuple[str, int] | str | None, range_bytes: int) -> dict[str, str]:
    text = EARLIEST if start is None else start if isinstance(start, str) else f"{start[0]}\n{start[1]}"
    return {"start": text, "rangeBytes": str(range_bytes), "tasks": str(spark.sparkContext.defaultParallelism)}


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PositionedLog)


def read_positioned_log(spark: SparkSession, folder: str, start: tuple[str, int] | str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Change events of a text log with their log_file, file_no and position (the end offset of the line).

    They go through every operator that needs places. ``start`` is a place (file, offset) or its two-line
    text, ``earliest`` or ``latest``: only later lines are read. An unfinished last line is read as it is.
    """
    register(spark)
    return parse_change_log(spark.read.format("positioned_log").options(**_options(spark, start, range_bytes)).load(folder))


def read_positioned_stream(spark: SparkSession, folder: str, start: tuple[str, int] | str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The same as a stream that tails the log; ``start`` counts until the query has a checkpoint."""
    register(spark)
    return parse_change_log(spark.readStream.format("positioned_log").options(**_options(spark, start, range_bytes)).load(folder))
