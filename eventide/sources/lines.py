"""Event-line files as a stream with offsets of its own (A4, C4, A2).

Spark's file source remembers which files it has seen, so a stream over it starts at the
beginning or not at all. This source remembers a position: per folder, the file and the byte
in it up to which lines were read. A stream may therefore start at the ``earliest`` line, at
the ``latest``, or right behind any row that was read before (every row carries its position).

What is read: each folder given (comma-separated) is one ordered sequence of files, as one
producer writes it. Files are taken in the order of their names; hidden ones (``_`` or ``.``
first) are left out. Only the newest file of a folder may still grow, and nothing shrinks or
changes. A line of the newest file counts once its newline is there; the last line of an older
file counts without one. A file that appears under a smaller name than one already read is not seen: that
is the price of an offset that does not grow with the number of files.

Rows: ``folder, file, position`` (byte where the line begins), ``next_position`` (byte behind
its newline: where to go on), ``value`` (binary, without the newline and a carriage return before it).
Empty lines are rows; files of no bytes have none.

A batch is planned from file sizes alone, plus a look at the end of a growing file for its last
newline. Files are cut into ranges of ``rangeBytes``, one task each, so that one long file does not
mean one long task. A task holds one block of lines at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import register_source

FORMAT = "event_lines"
SCHEMA = "folder string, file string, position long, next_position long, value binary"
BLOCK = 1 << 20  # bytes read at a time


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of a folder's files in name order; none if it is not there yet."""
    fs, path = file_system(folder)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[:1] not in "._")


def end_of_last_line(folder: str, name: str, size: int, block: int = BLOCK) -> int:
    """The byte behind the last newline of a file's first ``size`` bytes."""
    fs, path = file_system(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        end = size
        while end > 0:
            start = max(0, end - block)
            at = f.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def lines_between(f: pa.NativeFile, start: int, stop: int, block: int = BLOCK) -> Iterator[list[tuple[int, int, bytes]]]:
    """(position, next position, line) of the lines that begin in [start, stop), by blocks. A
    ``start`` inside a line begins with the next one; the last line is read to its end, which may lie behind ``stop``."""
    at, held = max(0, start - 1), []  # from the byte before: a newline there means that a line begins at start
    skipping, begin = start > 0, start
    f.seek(at)
    while skipping or begin < stop:
        data = f.read(block)
        if not data:
            break
        out, here = [], 0
        while here < len(data) and (skipping or begin < stop):
            nl = data.find(b"\n", here)
            if nl < 0:
                if not skipping:
                    held.append(data[here:])
                break
            if skipping:
                skipping = False
            else:
                line = b"".join([*held, data[here:nl]])
                held = []
                out.append((begin, at + nl + 1, line.removesuffix(b"\r")))
            begin, here = at + nl + 1, nl + 1
        at += len(data)
        yield out
    if held and begin < stop:  # a last line without newline
        line = b"".join(held)
        yield [(begin, begin + len(line), line.removesuffix(b"\r"))]


@dataclass
class Range(InputPartition):
    folder: str
    file: str
    start: int
    stop: int


class LinesReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folders = [p.strip().rstrip("/") for p in options["path"].split(",") if p.strip()]
        self.starting = options.get("startingOffsets", "earliest")
        self.range_bytes = int(options.get("rangeBytes", 64 << 20))
        if self.range_bytes < 1:
            raise ValueError("rangeBytes must be positive")
        if self.starting not in ("earliest", "latest"):
            given = json.loads(self.starting)
            unknown = set(given) - set(self.folders)
            if unknown:
                raise ValueError(f"startingOffsets names folders that are not read: {sorted(unknown)}")

    def initialOffset(self) -> dict:
        """The chosen start. A folder that a given start leaves out begins at its earliest line."""
        if self.starting == "earliest":
            return {}
        return self.latestOffset() if self.starting == "latest" else json.loads(self.starting)

    def latestOffset(self) -> dict:
        end = {}
        for folder in self.folders:
            files = list_files(folder)
            if files:
                name, size = files[-1]
                end[folder] = [name, end_of_last_line(folder, name, size)]
        return end

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for folder, (last, stop) in end.items():
            first, begin = start.get(folder) or ["", 0]
            for name, size in list_files(folder):
                if first <= name <= last:
                    a, b = (begin if name == first else 0), (stop if name == last else size)
                    out += [Range(folder, name, k, min(b, k + self.range_bytes)) for k in range(a, b, self.range_bytes)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(partition.folder)
        types = {"folder": pa.string(), "file": pa.string(), "position": pa.int64(), "next_position": pa.int64(), "value": pa.binary()}
        with fs.open_input_file(f"{path}/{partition.file}") as f:
            for rows in lines_between(f, partition.start, partition.stop):
                if rows:
                    at, behind, value = zip(*rows)
                    n = len(rows)
                    columns = [[partition.folder] * n, [partition.file] * n, at, behind, value]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    def commit(self, end: dict) -> None:
        """Nothing to let go: the files stay."""


class EventLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LinesReader:
        return LinesReader(self.options)


def read_event_lines(spark: SparkSession, folders: str | list[str], starting: str | dict = "earliest",
                     range_bytes: int = 64 << 20) -> DataFrame:
    """A stream of the lines of the folders. ``starting`` is ``earliest``, ``latest`` or
    {folder: (file, position)}; it counts for a new query only, a checkpoint goes on where it was."""
    register_source(spark, EventLines)
    start = starting if isinstance(starting, str) else json.dumps({k.rstrip("/"): list(v) for k, v in starting.items()})
    paths = [folders] if isinstance(folders, str) else folders
    return (spark.readStream.format(FORMAT).option("startingOffsets", start).option("rangeBytes", str(range_bytes))
            .load(",".join(paths)))


def position_behind(rows: DataFrame) -> dict:
    """Per folder the position behind the last of the rows read: a start for another
    stream. One row per folder comes to the driver."""
    from pyspark.sql import functions as F
    last = rows.groupBy("folder").agg(F.max(F.struct("file", "next_position")).alias("p"))
    return {r["folder"]: (r["p"]["file"], r["p"]["next_position"]) for r in last.collect()}
