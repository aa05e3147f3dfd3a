"""Listing of very many files by tasks instead of the driver, and looking up named ones.

Folders are walked by Arrow's file systems in Python workers, so stores need to be reachable from
there (local files, HDFS, S3 and GCS are). Files of length zero are listed too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTED = "path STRING, bucket STRING, key STRING, size BIGINT, mod_time TIMESTAMP, etag STRING"
FOUND = "file_path STRING, size BIGINT, mod_time TIMESTAMP"
#: Folders that the driver opens at most to deal the rest to tasks, unless told otherwise.
TASKS = 200
ROWS = 10_000

_LISTED = pa.schema(
    [("path", pa.string()), ("bucket", pa.string()), ("key", pa.string()), ("size", pa.int64()),
     ("mod_time", pa.timestamp("us", "UTC")), ("etag", pa.string())]
)
_FOUND = pa.schema([("file_path", pa.string()), ("size", pa.int64()), ("mod_time", pa.timestamp("us", "UTC"))])
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.DOTALL)


class Place:
    """A path taken apart: the store it is in, its root, and the path below the root."""

    def __init__(self, path: str) -> None:
        match = _URI.match(path)
        scheme, self.bucket, self.path = match.groups() if match else ("file", None, path)
        self.path = "/" + (self.path or "").lstrip("/")
        self.bucket = self.bucket or None
        self.root = f"{scheme.lower()}://{self.bucket or ''}"

    def open(self) -> tuple[stores.FileSystem, str]:
        """The file system, and what its paths begin with before ours. Hadoop has names of its own
        for S3."""
        if self.root == "file://":
            return stores.LocalFileSystem(), ""
        store, base = stores.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", self.root) + "/")
        return store, base.rstrip("/")


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _children(store: stores.FileSystem, folder: str, hidden: bool) -> tuple[list, list[str]]:
    """Files and folders right below a folder; none if it is gone by now."""
    found = store.get_file_info(stores.FileSelector(folder, recursive=False, allow_not_found=True))
    found = [f for f in found if hidden or not _hidden(f.base_name)]
    folders = [f.path for f in found if f.type == stores.FileType.Directory]
    return [f for f in found if f.type == stores.FileType.File], folders


class Folder(InputPartition):
    """A folder as a task; only its own files if ``deep`` is false."""

    def __init__(self, path: str, deep: bool) -> None:
        super().__init__(path)
        self.deep = deep


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, Any]) -> None:
        self.start = options["path"]
        self.tasks = int(options.get("tasks", TASKS))
        self.hidden = str(options.get("hidden", "false")).lower() == "true"

    def partitions(self) -> list[InputPartition]:
        """Folders are opened level by level until there are enough of them to deal out."""
        place = Place(self.start)
        store, base = place.open()
        start = base + (place.path.rstrip("/") or "/")
        if store.get_file_info(start).type == stores.FileType.NotFound:
            raise FileNotFoundError(self.start)
        opened, closed = [], [start]
        while closed and len(opened) + len(closed) < self.tasks:
            level, closed = closed, []
            for at, folder in enumerate(level):
                if len(opened) >= self.tasks:
                    closed += level[at:]
                    break
                opened.append(folder)
                closed += _children(store, folder, self.hidden)[1]
        return [Folder(f, False) for f in opened] + [Folder(f, True) for f in closed]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        place = Place(self.start)
        store, base = place.open()
        waiting, rows = [partition.value], []
        while waiting:
            files, folders = _children(store, waiting.pop(), self.hidden)
            if partition.deep:
                waiting += folders
            for file in files:
                path = file.path.removeprefix(base)
                rows.append((place.root + path, place.bucket, path.lstrip("/"), file.size, file.mtime, None))
                if len(rows) == ROWS:
                    yield _batch(rows, _LISTED)
                    rows = []
        if rows:
            yield _batch(rows, _LISTED)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


class Listing(DataSource):
    """``path``, ``bucket``, ``key``, ``size``, ``mod_time`` and ``etag`` of all files below ``path``.

    Options: ``tasks``, how many folders make tasks of their own, and ``hidden``, whether to list
    names that begin with ``_`` or ``.``, which Spark's readers leave out. Bucket is the authority
    of the path; stores do not tell the etag here, see :mod:`file_digests` for making it. The files
    of one folder are held by one task, a row of some hundred bytes each.
    """

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema: Any) -> DataSourceReader:
        return _Reader(dict(self.options))


def list_tree(spark: SparkSession, path: str, tasks: int = TASKS, hidden: bool = False) -> DataFrame:
    """Files below ``path``, listed by tasks; see :class:`Listing`."""
    spark.dataSource.register(Listing)
    options = {"tasks": str(tasks), "hidden": str(hidden).lower()}
    return spark.read.format("listing").options(**options).load(path)


def lookup(paths: DataFrame, column: str = "file_path") -> DataFrame:
    """``file_path``, ``size`` and ``mod_time`` of those of the named files that are there.

    Each path is asked for where its row lies; nothing is listed. Nulls and folders are not files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, tuple[stores.FileSystem, str]] = {}
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                if path is None:
                    continue
                place = Place(path)
                if place.root not in opened:
                    opened[place.root] = place.open()
                store, base = opened[place.root]
                file = store.get_file_info(base + place.path)
                if file.type == stores.FileType.File:
                    rows.append((path, file.size, file.mtime))
            if rows:
                yield _batch(rows, _FOUND)

    return paths.select(column).mapInArrow(run, FOUND)
