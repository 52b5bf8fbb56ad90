"""A tree of text files as a data source: read in batches of files by size, or as a stream of arrivals."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .names import unescaped

NAME = "text_tree"
SCHEMA = "artist string, song string, text string"
PARTITION_BYTES = 64 << 20
# what opening a file costs, in bytes read: many small files do not become one task
OPEN_BYTES = 256 << 10
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class _Settings:
    path: str
    partition_bytes: int
    escaped: bool
    settle: float

    @classmethod
    def of(cls, options: dict[str, str]) -> _Settings:
        if not options.get("path"):
            raise ValueError("the text tree needs a path")
        return cls(
            options["path"].rstrip("/"),
            int(options.get("partitionBytes", PARTITION_BYTES)),
            options.get("escaped", "false").lower() == "true",
            float(options.get("settleSeconds", 0)),
        )


@dataclass
class _Files(InputPartition):
    """Files of one task: (folder, name)."""

    files: list[tuple[str, str]]


def _listing(root: str) -> list[tuple[int, str, str, int]]:
    """(time, folder, name, size) of all files one folder below the root."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(root)
    found = []
    for folder in system.get_file_info(fs.FileSelector(place)):
        if not folder.is_file:
            for file in system.get_file_info(fs.FileSelector(folder.path)):
                if file.is_file:
                    found.append((file.mtime_ns, folder.base_name, file.base_name, file.size or 0))
    return found


def packed(files: list[tuple[int, str, str, int]], limit: int) -> list[_Files]:
    """Files by folder and name, dealt into tasks of about ``limit`` bytes; a larger file is a task of its own."""
    parts, now, size = [], [], 0
    for _, folder, name, length in sorted(files, key=lambda f: f[1:3]):
        cost = length + OPEN_BYTES
        if now and size + cost > limit:
            parts.append(_Files(now))
            now, size = [], 0
        now.append((folder, name))
        size += cost
    return [*parts, _Files(now)] if now else parts


def _read(settings: _Settings, files: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(settings.path)
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["artist", "song", "text"])

    for folder, name in files:
        with system.open_input_stream(f"{place}/{folder}/{name}") as file:
            text = file.readall().decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")
        bare = name.removesuffix(".txt")
        rows.append((unescaped(folder), unescaped(bare), text) if settings.escaped else (folder, bare, text))
        size += len(text)
        if size > BATCH_BYTES:
            yield batch()
            rows.clear()
            size = 0
    if rows:
        yield batch()


class _TreeReader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self.settings = settings

    def partitions(self) -> list[_Files]:
        return packed(_listing(self.settings.path), self.settings.partition_bytes) or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        return _read(self.settings, partition.files)


class _TreeStream(DataSourceStreamReader):
    """Files in the order of (time, folder, name); an offset is the last one taken."""

    def __init__(self, settings: _Settings):
        self.settings = settings

    def _settled(self) -> list[tuple[int, str, str, int]]:
        files = _listing(self.settings.path)
        if not self.settings.settle:
            return files
        latest = time.time_ns() - int(self.settings.settle * 1e9)
        return [f for f in files if f[0] <= latest]

    def initialOffset(self) -> dict:
        return {"time": -1, "folder": "", "name": ""}

    def latestOffset(self) -> dict:
        files = self._settled()
        if not files:
            return self.initialOffset()
        at = max(f[:3] for f in files)
        return dict(zip(("time", "folder", "name"), at))

    def partitions(self, start: dict, end: dict) -> list[_Files]:
        low, high = ((o["time"], o["folder"], o["name"]) for o in (start, end))
        return packed([f for f in _listing(self.settings.path) if low < f[:3] <= high], self.settings.partition_bytes)

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        return _read(self.settings, partition.files)


class TextTree(DataSource):
    """``artist, song, text`` from ``path/<artist>/<song>.txt``.

    Options: ``path``; ``partitionBytes``, the files of one task; ``escaped``, names as ``write_text_tree`` makes them; for streams
    ``settleSeconds``, how old a file must be: set it above the time that writers take, since files are taken in the
    order of their times and one that appears with an earlier time is not taken any more. The driver lists names and sizes.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(_Settings.of(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TreeStream(_Settings.of(self.options))


def _options(root: str, escaped: bool, settings: dict) -> dict[str, str]:
    return {"path": root, "escaped": str(escaped).lower(), **{k: str(v) for k, v in settings.items()}}


def load_text_tree(spark: SparkSession, root: str, escaped: bool = False, **settings) -> DataFrame:
    """The tree as a table, its files dealt into tasks by their sizes."""
    spark.dataSource.register(TextTree)
    return spark.read.format(NAME).options(**_options(root, escaped, settings)).load()


def stream_text_tree(spark: SparkSession, root: str, escaped: bool = False, **settings) -> DataFrame:
    """The tree as a stream: each file is read once, in the batch after it arrived."""
    spark.dataSource.register(TextTree)
    return spark.readStream.format(NAME).options(**_options(root, escaped, settings)).load()
