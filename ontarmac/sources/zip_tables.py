"""Monthly archives as a data source: ``spark.read.format("zip_tables").load(folder)``.

An archive is a partition. Its reader opens the file where it is and seeks: the central directory at its end says what is
inside, also beyond 4 GiB, and only the one table is inflated, a block at a time. So an archive may have any size, and none is held
whole. Year and month come from the file names, and filters on them leave archives out before any is opened.

Options: ``path`` (a folder, one archive, or a pattern such as ``raw/*_2024_*.zip``), or ``paths``, a JSON list of archives; ``mode``:
``blocks`` (default) gives the text of each table in blocks of whole lines, ``directory`` a row per archive with what its directory and
first line say (the columns of :func:`archives.inspect`), read without inflating the rest; ``block_bytes``.

Files are opened through Arrow's file systems, by drivers and tasks alike. Stores that only Spark can open are read as
``binaryFile`` rows (:func:`archives.read_archives`), which hold 2 GiB at most; :func:`opens` tells which it is.
"""

from __future__ import annotations

import io
import json
import re
import sys
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from zlib import error as InflateError

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from ontarmac.constants import ARCHIVE_NAME
from ontarmac.sources.archives import BLOCK_BYTES, line_blocks, lines_of, tables_in

# tasks get these functions themselves, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "zip_tables"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
SCHEMAS = {
    "blocks": "path string, year int, month int, block int, text string",
    "directory": "path string, year int, month int, length bigint, is_zip boolean, csv_members int, table_bytes bigint, header string",
}


# --- files -----------------------------------------------------------------------------------------


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme is None or scheme[1] == "file":
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return pafs.FileSystem.from_uri(path)


class _Held(io.RawIOBase):
    """An open file of any file system in the terms of Python's own, which the ZIP reader relies on."""

    def __init__(self, native: pa.NativeFile):
        self.native, self.size = native, native.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.native.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self.native.tell(), self.size)[whence]
        if place < 0:
            raise OSError("before the start of the file")
        self.native.seek(place)
        return place

    def readinto(self, target) -> int:
        return self.native.readinto(target)

    def close(self) -> None:
        self.native.close()
        super().close()


def opened(path: str) -> io.BufferedReader:
    files, inner = located(path)
    return io.BufferedReader(_Held(files.open_input_file(inner)), 1 << 18)


def opens(path: str) -> bool:
    """Whether Arrow has a file system for the path."""
    try:
        files, inner = located(path)
        files.get_file_info(inner)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


@dataclass(frozen=True)
class Archive(InputPartition):
    path: str
    year: int | None = None
    month: int | None = None
    length: int = 0


def named(path: str, length: int = 0) -> Archive | None:
    """The archive at a path; None where the file is not named like a monthly one."""
    found = re.fullmatch(ARCHIVE_NAME, path.rsplit("/", 1)[-1])
    return Archive(path, int(found[1]), int(found[2]), length) if found else None


def listed(path: str) -> list[Archive]:
    """Monthly archives of a folder, those that a pattern in the last part of the path picks, or the one that is named."""
    files, inner = located(path.rstrip("/"))
    prefix = path.rstrip("/")[: len(path.rstrip("/")) - len(inner)] if path.rstrip("/").endswith(inner) else ""
    info = files.get_file_info(inner)
    if info.type == pafs.FileType.File:
        found = [info]
    elif info.type == pafs.FileType.Directory:
        found = files.get_file_info(pafs.FileSelector(inner))
    else:
        folder, pattern = inner.rsplit("/", 1)
        if not re.search(r"[*?\[]", pattern):
            raise FileNotFoundError(path)
        found = [f for f in files.get_file_info(pafs.FileSelector(folder)) if fnmatch(f.base_name, pattern)]
    held = (named(prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File)
    return sorted((a for a in held if a), key=lambda a: a.path)


# --- readers ---------------------------------------------------------------------------------------


class ZipTables(DataSource):
    """The data source; register it with :func:`register`."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _mode(self) -> str:
        mode = self.options.get("mode", "blocks")
        if mode not in SCHEMAS:
            raise ValueError(f"mode {mode}: choose from {', '.join(SCHEMAS)}")
        return mode

    def schema(self) -> str:
        return SCHEMAS[self._mode()]

    def reader(self, schema) -> ZipReader:
        paths = self.options.get("paths")
        if paths is None and "path" not in self.options:
            raise ValueError("a path is needed")
        wanted = [self.options["path"]] if paths is None else json.loads(paths)
        block_bytes = int(self.options.get("block_bytes", BLOCK_BYTES))
        return ZipReader(self._mode(), wanted, paths is not None, block_bytes)


_COMPARED = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b,
}


class ZipReader(DataSourceReader):
    def __init__(self, mode: str, paths: list[str], exact: bool, block_bytes: int):
        self.mode, self.paths, self.exact, self.block_bytes = mode, paths, exact, block_bytes
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of year and month, which the file names answer; gives the others back."""
        for f in filters:
            if type(f) in _COMPARED and f.attribute in (("year",), ("month",)):
                self.filters.append(f)
            else:
                yield f

    def _wanted(self, archive: Archive) -> bool:
        return all(_COMPARED[type(f)](getattr(archive, f.attribute[0]), f.value) for f in self.filters)

    def partitions(self) -> list[Archive]:
        if self.exact:
            found = [named(p) for p in self.paths]
            if None in found:
                raise ValueError(f"not named like a monthly archive: {self.paths[found.index(None)]}")
        else:
            found = [a for p in self.paths for a in listed(p)]
        return [a for a in found if self._wanted(a)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in SCHEMAS[self.mode].split(", "))])
        if partition is None or partition.path is None:  # planned for an empty list
            return
        rows = (inspected if self.mode == "directory" else blocks)(partition, self.block_bytes)
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def _table(archive: zipfile.ZipFile, path: str) -> zipfile.ZipInfo:
    tables = tables_in(archive)
    if len(tables) != 1:
        raise ValueError(f"{path}: one table is expected in an archive, not {len(tables)}")
    return tables[0]


def blocks(archive: Archive, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple]:
    """The table's text in blocks of whole lines, the first with the header; reads on as blocks are asked for."""
    with opened(archive.path) as held, zipfile.ZipFile(held) as inside:
        with inside.open(_table(inside, archive.path)) as member:
            for i, text in enumerate(line_blocks(member, block_bytes)):
                yield archive.path, archive.year, archive.month, i, text


def inspected(archive: Archive, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple]:
    """One row: what the directory says, and the first line of a single table."""
    files, inner = located(archive.path)
    start = (archive.path, archive.year, archive.month, files.get_file_info(inner).size)
    try:
        with opened(archive.path) as held, zipfile.ZipFile(held) as inside:
            tables, header = tables_in(inside), None
            if len(tables) == 1:
                with inside.open(tables[0]) as member:
                    header = lines_of(next(line_blocks(member, min(block_bytes, 1 << 16)), ""))[0]
            yield *start, True, len(tables), sum(t.file_size for t in tables), header
    except (zipfile.BadZipFile, InflateError, EOFError):
        yield *start, False, 0, None, None


# --- use -------------------------------------------------------------------------------------------


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let filters on year and month reach it."""
    spark.dataSource.register(ZipTables)
    spark.conf.set(PUSHDOWN, "true")


def read(spark: SparkSession, path: str | list[str], mode: str = "blocks") -> DataFrame:
    """Archives of a folder or pattern, or those of a list."""
    register(spark)
    reader = spark.read.format(NAME).option("mode", mode)
    return reader.load(path) if isinstance(path, str) else reader.option("paths", json.dumps(path)).load()
