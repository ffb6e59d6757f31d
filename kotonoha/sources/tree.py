"""Trees of files: listed level by level, and as a data source that streams changes.

``list_tree`` lists a frontier of folders in one Spark job per level: every task
gets some folders, lists their children and hands the subfolders back as the next
frontier, which is dealt out anew. No task walks a subtree, and no name passes
through the driver.

``file_tree`` is the same listing as a Python data source. Its stream has time as
offset: a micro-batch holds the files that changed since the one before, and
those below a folder that changed, since files that are moved keep their time.
``run_windows`` streams the numbers of new runs of a log of ``run_id=`` folders.

Folders are read through Arrow's file systems.
"""

from __future__ import annotations

import fnmatch
import json
import re
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from kotonoha.plans.layout import cut_lineage

# Folders that a data source hands to one task at most, and slices it aims at.
FOLDERS_AT_ONCE = 1_000
SLICES = 256
# Start of the first window.
EVER = float("-inf")
# Rows of one Arrow batch of a listing.
LISTED_ROWS = 10_000
# A change is listed again for this long, in case a store shows it late.
OVERLAP_SECONDS = 5.0

LISTING = "path string, modificationTime timestamp, length long"
_ARROW = pa.schema(
    [("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())]
)


def arrow_place(path: str):
    """Arrow's file system and the path in it; None where Arrow has no such store."""
    scheme, colon, rest = path.partition(":")
    escaped = scheme + colon + quote(rest, safe="/:@")
    try:
        return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", escaped))
    except (pa.ArrowInvalid, OSError):
        return None


def children(folder: str) -> list[tuple[str, pafs.FileInfo]]:
    """(path, info) of what stands directly in a folder; nothing where it is gone."""
    if (place := arrow_place(folder)) is None:
        raise ValueError(f"no file system for {folder}")
    system, inside = place
    found = system.get_file_info(pafs.FileSelector(inside, recursive=False, allow_not_found=True))
    base = folder.rstrip("/")
    return [(f"{base}/{info.base_name}", info) for info in sorted(found, key=lambda i: i.base_name)]


def _matches(name: str, patterns: Iterable[str]) -> bool:
    return any(fnmatch.fnmatchcase(name, p) for p in patterns)


def as_patterns(patterns: str | Iterable[str]) -> list[str]:
    """A lone string is one pattern."""
    return [patterns] if isinstance(patterns, str) else sorted(set(patterns))


def _batches(rows: Iterable[tuple], schema: pa.Schema = _ARROW) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == LISTED_ROWS:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def list_tree(roots: DataFrame, patterns: str | Iterable[str]) -> DataFrame:
    """``[path, modificationTime, length]`` of all files below the ``[folder]`` rows.

    One job per level of the tree. Empty files and names that start with ``_`` or
    ``.`` count like others. Roots may lie in each other; a missing root is empty.
    """
    spark, names = roots.sparkSession, as_patterns(patterns)
    schema = _ARROW.append(pa.field("is_folder", pa.bool_()))

    def listed(batches):
        def rows():
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    for path, info in children(folder):
                        is_folder = info.type == pafs.FileType.Directory
                        if is_folder or (info.type == pafs.FileType.File and _matches(info.base_name, names)):
                            yield path, info.mtime, info.size, is_folder

        yield from _batches(rows(), schema)

    most = 4 * spark.sparkContext.defaultParallelism
    frontier = cut_lineage(roots.select(F.col("folder").alias("path")).distinct())
    files = spark.createDataFrame([], LISTING)
    while n := frontier.count():
        dealt = frontier.repartition(max(1, min(n, most, -(-n // 8))))
        level = cut_lineage(dealt.mapInArrow(listed, f"{LISTING}, is_folder boolean"))
        files = files.unionByName(level.where(~F.col("is_folder")).drop("is_folder"))
        frontier = level.where("is_folder").select("path")
    return files.dropDuplicates(["path"])


@dataclass
class FolderSlice(InputPartition):
    """(folder, whether its subfolders belong to it, whether it changed) rows, and the window's start."""

    folders: list[tuple[str, bool, bool]]
    since: float


def _changed(info: pafs.FileInfo, since: float) -> bool:
    """Later than ``since``; without a time only the first window has it."""
    return info.mtime.timestamp() > since if info.mtime else since == EVER


class _Tree:
    """What batch and stream readers share: options, slices of folders, their files."""

    def __init__(self, options):
        self.roots = json.loads(options["roots"]) if "roots" in options else [options["path"]]
        self.patterns = json.loads(options.get("patterns", '["*"]'))
        self.slices = int(options.get("slices", SLICES))

    def frontier(self, since: float) -> list[tuple[str, bool, bool]]:
        """Folders level by level until there are enough to deal out."""
        top = []
        for root in dict.fromkeys(self.roots):
            if (place := arrow_place(root)) is None:
                raise ValueError(f"no file system for {root}")
            top.append((root.rstrip("/"), _changed(place[0].get_file_info(place[1]), since)))
        done, level = [], top
        while level and len(done) + len(level) < self.slices:
            done += [(folder, False, changed) for folder, changed in level]
            level = [
                (path, changed or _changed(info, since))
                for folder, changed in level
                for path, info in children(folder)
                if info.type == pafs.FileType.Directory
            ]
        return done + [(folder, True, changed) for folder, changed in level]

    def slice(self, since: float) -> list[FolderSlice]:
        folders = self.frontier(since)
        size = max(1, min(FOLDERS_AT_ONCE, -(-len(folders) // self.slices)))
        return [FolderSlice(folders[i : i + size], since) for i in range(0, len(folders), size)]

    def files(self, part: FolderSlice) -> Iterator[pa.RecordBatch]:
        def rows():
            waiting = part.folders[::-1]
            while waiting:
                folder, deep, changed = waiting.pop()
                for path, info in children(folder):
                    if info.type == pafs.FileType.Directory:
                        if deep:
                            waiting.append((path, True, changed or _changed(info, part.since)))
                    elif info.type == pafs.FileType.File and _matches(info.base_name, self.patterns):
                        # A store without times of folders dates a file by its arrival.
                        if changed or _changed(info, part.since):
                            yield path, info.mtime, info.size

        yield from _batches(rows())


class TreeReader(DataSourceReader):
    def __init__(self, options):
        self._tree = _Tree(options)

    def partitions(self):
        return self._tree.slice(EVER)

    def read(self, partition):
        yield from self._tree.files(partition)


class TreeStream(DataSourceStreamReader):
    """Offsets are microseconds; the first window is open downwards."""

    def __init__(self, options):
        self._tree = _Tree(options)

    def initialOffset(self):
        return {"until": 0}

    def latestOffset(self):
        return {"until": int(time.time() * 1e6)}

    def partitions(self, start, end):
        since = start["until"] / 1e6 - OVERLAP_SECONDS if start["until"] else EVER
        return self._tree.slice(since)

    def read(self, partition):
        yield from self._tree.files(partition)

    def commit(self, end):
        pass


class FileTree(DataSource):
    """``spark.read`` or ``spark.readStream`` with ``.format("file_tree").load(root)``.

    Options: ``patterns`` and ``roots`` as JSON lists. A row is a file; contents
    are not read. A stream gives a file again when it changed or when a folder
    above it did, so that nothing is missed; who reads it knows what is new.
    """

    @classmethod
    def name(cls):
        return "file_tree"

    def schema(self):
        return LISTING

    def reader(self, schema):
        return TreeReader(self.options)

    def streamReader(self, schema):
        return TreeStream(self.options)


def _numbered(folder: str, prefix: str) -> list[tuple[int, str]]:
    found = [(p, i.base_name) for p, i in children(folder) if i.base_name.startswith(prefix)]
    return sorted((int(name[len(prefix) :]), p) for p, name in found)


def _marks(folder: str) -> set[str]:
    return {i.base_name for _, i in children(folder) if i.base_name.startswith("_")}


def _runs(path: str) -> dict[int, str]:
    """Folders of the runs in the newest whole generation of a log, finished or not."""
    generations = [p for g, p in _numbered(path, "gen=") if g == 0 or "_SUCCESS" in _marks(p)]
    return dict(_numbered(generations[-1], "run_id=")) if generations else {}


def _finished(folder: str) -> bool:
    """A run that is being written holds a temporary folder; compacted ones have no mark."""
    found = _marks(folder)
    return "_SUCCESS" in found or "_temporary" not in found


def _noted(path: str) -> set[int]:
    """The runs that streams have set aside for their batches."""
    found = set()
    for stream in [p for p, i in children(path) if i.type == pafs.FileType.Directory]:
        for _, batch in _numbered(stream, "batch="):
            for file, info in children(batch):
                if info.base_name.endswith(".parquet"):
                    system, inside = arrow_place(file)
                    found.update(pq.read_table(inside, filesystem=system).column("run").to_pylist())
    return found


@dataclass
class Windows(InputPartition):
    rows: list[tuple[int, int]]


class RunStream(DataSourceStreamReader):
    """Offsets are run numbers, which stay the same when a log is compacted.

    A run that a stream has set aside may be written after later ones; the offset
    names those, and each is a window of its own once it is there.
    """

    def __init__(self, options):
        self._path, self._notes = options["path"], options.get("notes")

    def initialOffset(self):
        return {"run": 0, "open": []}

    def latestOffset(self):
        runs = _runs(self._path)
        newest = next((r for r in sorted(runs, reverse=True) if _finished(runs[r])), 0)
        noted = _noted(self._notes) if self._notes else set()
        late = sorted(r for r in noted if r < newest and not (r in runs and _finished(runs[r])))
        return {"run": newest, "open": late}

    def partitions(self, start, end):
        # A note may also have gone without a run in this log, such as a token stream's own.
        runs = _runs(self._path) if start["open"] else {}
        late = [(r - 1, r) for r in start["open"] if r not in end["open"] and r in runs]
        new = [(start["run"], end["run"])] if end["run"] > start["run"] else []
        return [Windows(late + new)] if late or new else []

    def read(self, partition):
        yield from partition.rows

    def commit(self, end):
        pass


class RunWindows(DataSource):
    """A stream of ``[after, until]`` rows over the runs of a log: after < run <= until is new.

    Options: the log's folder as ``path`` and, for late runs, that of the streams' ``notes``.
    """

    @classmethod
    def name(cls):
        return "run_windows"

    def schema(self):
        return "after long, until long"

    def streamReader(self, schema):
        return RunStream(self.options)


def register_sources(spark: SparkSession) -> None:
    for source in (FileTree, RunWindows):
        spark.dataSource.register(source)
