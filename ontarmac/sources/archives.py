"""Monthly ZIP archives of CSV: what there is, what is new, and what is inside.

Archives are Spark ``binaryFile`` rows. Each is inflated by the task that holds it, piece by piece; splitting
into lines and parsing CSV is left to Spark's own expressions.
"""

from __future__ import annotations

import csv
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import date
from pathlib import PurePosixPath
from zlib import error as InflateError

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontarmac import constants as K

# tasks get these functions themselves, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 1 << 20
HOT_ARCHIVE_BYTES = 256 << 20

REPORT_SCHEMA = "path string, length bigint, is_zip boolean, csv_members int, header string"
BLOCK_SCHEMA = "path string, block int, text string"
_LINE_END = "\r\n|\n|\r"


# --- what there is ---------------------------------------------------------------------------------


def read_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Archive files. A plan that leaves out ``content`` lists them without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(paths)


def manifest(files: DataFrame) -> DataFrame:
    """Year, month and file name of every file named like a monthly archive; other files are left out."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    exact = f"^{K.ARCHIVE_NAME}$"
    return (
        files.withColumn("filename", name)
        .filter(F.col("filename").rlike(exact))
        .withColumns(
            {
                "year": F.regexp_extract("filename", exact, 1).cast("int"),
                "month": F.regexp_extract("filename", exact, 2).cast("int"),
            }
        )
    )


def year_month(value: str) -> int:
    """``"2024-05"`` as 202405."""
    if len(value) != 7:
        raise ValueError(f"not a month in the form YYYY-MM: {value}")
    first = date.fromisoformat(f"{value}-01")
    return first.year * 100 + first.month


def within_months(start: str | None, end: str | None) -> Column:
    """Whether a row is from the first to the last month, both included; None leaves that side open."""
    first, last = (None if value is None else year_month(value) for value in (start, end))
    if first is not None and last is not None and first > last:
        raise ValueError(f"{start} is after {end}")
    month = F.col("year") * 100 + F.col("month")
    return (F.lit(True) if first is None else month >= first) & (F.lit(True) if last is None else month <= last)


def in_months(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return df.filter(within_months(start, end))


def one_per_month(df: DataFrame, last: bool = False) -> DataFrame:
    """Of several archives of a month the first by path, or the last."""
    pick = F.max if last else F.min
    others = [c for c in df.columns if c not in ("year", "month", "path")]
    row = pick(F.struct("path", *others)).alias("row")
    return df.groupBy("year", "month").agg(row).select("year", "month", "row.*")


def landed_months(spark: SparkSession, root: str) -> DataFrame:
    """Months below a curated root, from its file names alone."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "year int, month int")
    part = r"/year=(\d+)/month=(\d+)/"
    return (
        files.filter(F.col("path").rlike(part))
        .select(*[F.regexp_extract("path", part, i).cast("int").alias(c) for i, c in ((1, "year"), (2, "month"))])
        .distinct()
    )


def pending(months: DataFrame, landed: DataFrame) -> DataFrame:
    return months.join(landed, ["year", "month"], "left_anti")


def month_summary(months: DataFrame) -> DataFrame:
    """How many months there are, and the first and last of them."""
    ym = F.col("year") * 100 + F.col("month")
    return months.agg(F.count("*").alias("months"), F.min(ym).alias("first_month"), F.max(ym).alias("last_month"))


def target_path(root: str) -> Column:
    return F.format_string(f"{root.rstrip('/')}/year=%d/month=%02d", F.col("year"), F.col("month"))


# --- what is inside --------------------------------------------------------------------------------


def tables_in(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """The members that hold tables."""
    return [member for member in archive.infolist() if PurePosixPath(member.filename).suffix.lower() == ".csv"]


def line_blocks(member, block_bytes: int | None = None) -> Iterator[str]:
    """Whole lines in pieces of about ``block_bytes`` (``BLOCK_BYTES``), from the first line that is not blank."""
    rest, started = b"", False
    while piece := member.read(block_bytes or BLOCK_BYTES):
        held = rest + piece
        cut = (held.rfind(b"\n") + 1) or (held.rfind(b"\r", 0, -1) + 1)  # a last CR may belong to a CR LF
        block, rest = held[:cut], held[cut:]
        if not started:
            block = block.removeprefix(b"\xef\xbb\xbf").lstrip()
            started = bool(block)
        if block:
            yield block.decode("utf-8", errors="replace")
    if rest:
        yield (rest if started else rest.removeprefix(b"\xef\xbb\xbf").lstrip()).decode("utf-8", errors="replace")


def lines_of(text: str) -> list[str]:
    return re.split(_LINE_END, text)


def _inspect(path: str, content: bytes) -> tuple:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            tables = tables_in(archive)
            header = None
            if len(tables) == 1:
                with archive.open(tables[0]) as member:
                    header = lines_of(next(line_blocks(member), ""))[0]
            return path, len(content), True, len(tables), header
    except (zipfile.BadZipFile, InflateError, EOFError):
        return path, len(content), False, 0, None


def _inspect_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "length", "is_zip", "csv_members", "header"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    for batch in batches:
        rows = [_inspect(p.as_py(), c.as_py()) for p, c in zip(batch.column("path"), batch.column("content"))]
        columns = [pa.array(values, t) for values, t in zip(zip(*rows), types)] if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema=schema)


def _unpack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                tables = tables_in(archive)
                if len(tables) != 1:
                    raise ValueError(f"{path.as_py()}: one table is expected in an archive, not {len(tables)}")
                with archive.open(tables[0]) as member:
                    for i, text in enumerate(line_blocks(member)):
                        yield pa.RecordBatch.from_pydict(
                            {"path": [path.as_py()], "block": pa.array([i], pa.int32()), "text": [text]}
                        )


def inspect(archives: DataFrame) -> DataFrame:
    """Per archive: its length, whether it is a ZIP, its number of CSV members, and its header line."""
    return archives.select("path", "content").mapInArrow(_inspect_batches, REPORT_SCHEMA)


def integrity(report: DataFrame, listed: DataFrame) -> DataFrame:
    """Check inspected archives against the sizes a listing gives; an unlisted size is not checked."""
    named = report.withColumn("filename", F.regexp_extract("path", r"([^/]+)$", 1))
    expected = listed.select("filename", F.col("size_bytes").alias("expected"))
    return (
        named.join(expected, "filename", "left")
        .withColumn("size_ok", F.col("expected").isNull() | (F.col("length") == F.col("expected")))
        .select("filename", "length", "expected", "size_ok", "is_zip", (F.col("size_ok") & F.col("is_zip")).alias("ok"))
    )


def unpack(archives: DataFrame) -> DataFrame:
    """The text of each archive's one CSV member in blocks of whole lines; any other count is an error."""
    return archives.select("path", "content").mapInArrow(_unpack_batches, BLOCK_SCHEMA)


def header_names(header: str) -> list[str]:
    """Column names as the CSV reader gives them: ``_c<n>`` for unnamed ones, numbers behind repeated ones."""
    names = next(csv.reader([header]))
    lower = [n.lower() for n in names]
    return [
        f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)
    ]


def parse(blocks: DataFrame, header: str, keep: list[str]) -> DataFrame:
    """All-string rows of text blocks under one header, behind the block columns to ``keep``.

    A row with too few or too many fields stops the job. Unnamed columns are dropped, and so are columns
    named like a kept one.
    """
    names = header_names(header)
    schema = ", ".join(f"f{i} string" for i in range(len(names)))  # header names may hold any character
    lines = F.split("text", _LINE_END)
    body = F.when(F.col("block") == 0, F.slice(lines, F.lit(2), F.size(lines))).otherwise(lines)
    rows = (
        blocks.select(*keep, F.explode(body).alias("line"))
        .filter(F.trim("line") != "")
        .select(*keep, F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("row"))
    )
    kept = {k.lower() for k in keep}
    named = {f"f{i}": n for i, n in enumerate(names) if not re.fullmatch(r"_c\d+", n) and n.lower() not in kept}
    return rows.select(*keep, *[F.col("row").getField(f).alias(n) for f, n in named.items()])
