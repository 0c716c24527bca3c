"""Landing feeds as a data source: lines of CSV or JSON files, in batches and in streams.

A partition is a set of byte ranges; a range owns the lines that begin in it, so large files are read
by many tasks and small ones share a task; what is read at once is dealt over the session's cores.  Every byte is read once, but for the header line, which each range
of a CSV file takes from the file's beginning.  Rows carry the raw line and the place of each
declared column in the file's own header; parsing stays with Spark's expressions
(:func:`quarrylens.sources.landing.feed_rows`).  A filter on ``_batch``, the folder that the
pattern's first wildcard stands for, prunes the listing where the session lets Python sources take
filters (``spark.sql.python.filterPushdown.enabled``); elsewhere Spark filters the rows.

As a stream the offset is the number of entries in a log of file names, kept beside the checkpoint:
an entry names the new files of one micro-batch, at most ``files_per_trigger``.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "value string, places array<int>, width int, _batch string, _source_file string"
BLOCK = 4 << 20
RANGE = 64 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4")


@dataclass(frozen=True)
class Found:
    path: str
    batch: str
    size: int
    changed: int


@dataclass
class Ranges(InputPartition):
    """Pieces (path, batch, begin, end) of one task."""

    pieces: list[tuple[str, str, int, int]]


def _system(pattern: str) -> tuple[pyarrow.fs.FileSystem, str, str]:
    """File system, path inside it, and what to put before such a path to name it outside."""
    if pattern.startswith("file:"):
        pattern = "/" + pattern.removeprefix("file:").lstrip("/")
    system, inner = pyarrow.fs.FileSystem.from_uri(pattern)
    return system, inner, "file://" if pattern.startswith("/") else pattern[: len(pattern) - len(inner)]


def _children(system: pyarrow.fs.FileSystem, folder: str) -> list[pyarrow.fs.FileInfo]:
    selector = pyarrow.fs.FileSelector(folder, allow_not_found=True)
    return [i for i in system.get_file_info(selector) if not i.base_name.startswith(("_", "."))]


def find(pattern: str, batches: set[str] | None = None) -> list[Found]:
    """Files that a pattern names, or that lie under the folders it names; folders of other batches are not listed."""
    system, inner, prefix = _system(pattern)
    parts = inner.strip("/").split("/")
    fixed = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[")), len(parts))
    level = [system.get_file_info("/" + "/".join(parts[:fixed]) if inner.startswith("/") else "/".join(parts[:fixed]))]
    # Without a wildcard the batch is the folder around what is named.
    named = parts[-2] if fixed == len(parts) and len(parts) > 1 else None
    nodes = [(i, named) for i in level if i.type != pyarrow.fs.FileType.NotFound]
    if named is not None and batches is not None and named not in batches:
        return []
    for at in range(fixed, len(parts)):
        found = []
        for node, batch in nodes:
            if node.type != pyarrow.fs.FileType.Directory:
                continue
            for child in _children(system, node.path):
                mine = batch if batch is not None else child.base_name
                if fnmatchcase(child.base_name, parts[at]) and (batches is None or mine in batches):
                    found.append((child, mine))
        nodes = found
    out = []
    while nodes:
        node, batch = nodes.pop()
        if node.type == pyarrow.fs.FileType.Directory:
            nodes += [(child, batch) for child in _children(system, node.path)]
        else:
            out.append(Found(prefix + node.path, batch or "", node.size or 0, node.mtime_ns or 0))
    return sorted(set(out), key=lambda f: (f.changed, f.path))


def deal(found: Iterable[Found], range_bytes: int) -> list[Ranges]:
    """Byte ranges of at most ``range_bytes``, small ones together; packed files cannot be cut."""
    pieces = []
    for f in found:
        if f.path.endswith(PACKED):
            pieces.append((f.path, f.batch, 0, -1, f.size))
        else:
            pieces += [(f.path, f.batch, at, min(at + range_bytes, f.size), min(range_bytes, f.size - at)) for at in range(0, f.size, range_bytes)]
    out, size = [], 0
    for *piece, n in pieces:
        if not out or size + n > range_bytes:
            out.append(Ranges([]))
            size = 0
        out[-1].pieces.append(tuple(piece))
        size += n
    return out


def share(found: Iterable[Found], range_bytes: int, cores: int) -> int:
    """Bytes of a range that give each core one, a block at least and ``range_bytes`` at most."""
    return min(range_bytes, max(BLOCK, -(-sum(f.size for f in found) // cores)))


def _header(line: bytes) -> list[str]:
    text = line.decode("utf-8", "replace").removeprefix("﻿").rstrip("\r")
    return [n.strip() for n in next(csv.reader([text]), [])]


def _lines(path: str, begin: int, end: int) -> Iterator[list[bytes]]:
    """Blocks of whole lines that begin in [begin, end); ``end`` -1 is the end of a packed file."""
    system, inner, _ = _system(path)
    if end < 0:
        stream = system.open_input_stream(inner)
    else:
        stream = system.open_input_file(inner)
        # A line begins here if the byte before ends one.
        stream.seek(max(0, begin - 1))
    at, rest, first = max(0, begin - 1), b"", begin > 0
    with stream:
        while True:
            block = stream.read(BLOCK)
            held = rest + block
            if first:
                cut = held.find(b"\n")
                if cut < 0 and block:
                    rest = held
                    continue
                at, held, first = at + cut + 1 if cut >= 0 else at + len(held), held[cut + 1 :] if cut >= 0 else b"", False
            # ``at`` is the place of held[0]: lines that begin at ``end`` or later are the next range's.
            last = not block
            whole = len(held) if last else held.rfind(b"\n") + 1
            lines = held[:whole].split(b"\n")
            if lines and not lines[-1]:
                lines.pop()
            rest, over = held[whole:], False
            if 0 <= end < at + whole:
                starts = at + np.cumsum([0] + [len(x) + 1 for x in lines[:-1]])
                lines = lines[: int(np.searchsorted(starts, end))]
                over = True
            at += whole
            if lines:
                yield lines
            if last or over or 0 <= end <= at:
                return


def _first_line(path: str) -> bytes:
    system, inner, _ = _system(path)
    with system.open_input_file(inner) as file:
        line = b""
        while b"\n" not in line:
            block = file.read(4096)
            if not block:
                break
            line += block
    return line.split(b"\n", 1)[0]


class _Reading:
    """What both readers share: options, and how a partition becomes rows."""

    def __init__(self, options: dict[str, str]):
        self.patterns = json.loads(options["paths"])
        self.columns = json.loads(options["columns"])
        self.csv = options.get("format", "csv") == "csv"
        self.range_bytes = int(options.get("range_bytes", RANGE))
        self.cores = int(options.get("cores", 1))

    def dealt(self, found: list[Found]) -> list[Ranges]:
        return deal(found, share(found, self.range_bytes, self.cores)) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for path, batch, begin, end in partition.pieces:
            names = None
            if self.csv and begin > 0:
                names = _header(_first_line(path))
            for lines in _lines(path, begin, end):
                if self.csv and names is None:
                    names, lines = _header(lines[0]), lines[1:]
                # Empty lines are no rows, as in Spark's own readers.
                rows = [x for x in (line.removesuffix(b"\r") for line in lines) if x.strip()]
                if not rows:
                    continue
                places = [names.index(c) + 1 if c in names else 0 for c in self.columns] if self.csv else []
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r.decode("utf-8", "replace") for r in rows], pa.string()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * len(places), pa.int32()), pa.array(np.tile(np.array(places, np.int32), n), pa.int32())
                        ),
                        pa.array(np.full(n, len(names or ())), pa.int32()),
                        pa.array([batch] * n, pa.string()),
                        pa.array([path] * n, pa.string()),
                    ],
                    names=["value", "places", "width", "_batch", "_source_file"],
                )


class PlainFeedReader(_Reading, DataSourceReader):
    batches: set[str] | None = None

    def partitions(self) -> list[Ranges]:
        found = {f for p in self.patterns for f in find(p, self.batches)}
        return self.dealt(sorted(found, key=lambda f: f.path))


class FeedReader(PlainFeedReader):
    """Takes filters; Spark refuses a reader with this method where its setting is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("_batch",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.batches = wanted if self.batches is None else self.batches & wanted
            else:
                yield f


class FeedStreamReader(_Reading, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.limit = int(options.get("files_per_trigger", 1000))
        self.log, self.inner, _ = _system(options["log"])
        self.log.create_dir(self.inner, recursive=True)
        entries = [i.base_name for i in _children(self.log, self.inner) if i.base_name.endswith(".json")]
        self.done = len(entries)
        self.seen = {f["path"] for n in range(1, self.done + 1) for f in self._entry(n)}
        # Files of the last listing that no entry names yet; the folders are listed again when there are none.
        self.waiting: list[Found] = []

    def _name(self, number: int) -> str:
        return f"{self.inner}/{number:012d}.json"

    def _entry(self, number: int) -> list[dict]:
        with self.log.open_input_stream(self._name(number)) as file:
            return json.loads(file.read())

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        if not self.waiting:
            fresh = {f for p in self.patterns for f in find(p) if f.path not in self.seen}
            self.waiting = sorted(fresh, key=lambda f: (f.changed, f.path))
        fresh = self.waiting[: self.limit]
        if fresh:
            draft = f"{self.inner}/.draft-{self.done + 1}"
            with self.log.open_output_stream(draft) as file:
                file.write(json.dumps([vars(f) for f in fresh]).encode())
            self.log.move(draft, self._name(self.done + 1))
            self.done += 1
            self.seen.update(f.path for f in fresh)
            self.waiting = self.waiting[self.limit :]
        return {"entries": self.done}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        found = [Found(**f) for n in range(start["entries"] + 1, end["entries"] + 1) for f in self._entry(n)]
        return self.dealt(found)

    def commit(self, end: dict) -> None:
        """The log stays: it says which files were seen."""


class LandingFeed(DataSource):
    """Options: ``paths`` and ``columns`` (JSON lists), ``format``, ``range_bytes``, ``cores``, ``prune``; for streams ``log``, ``files_per_trigger``."""

    @classmethod
    def name(cls) -> str:
        return "landing_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return (FeedReader if self.options.get("prune") == "true" else PlainFeedReader)(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FeedStreamReader(self.options)


def feed_options(spark: SparkSession, paths: list[str], columns: list[str], fmt: str, **more: object) -> dict[str, str]:
    """Register the source with the session and spell out its options."""
    spark.dataSource.register(LandingFeed)
    prune = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    out = {"paths": json.dumps(paths), "columns": json.dumps(columns), "format": fmt, "prune": prune}
    out["cores"] = str(spark.sparkContext.defaultParallelism)
    return out | {name: str(value) for name, value in more.items()}
