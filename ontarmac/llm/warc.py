"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges.

Reading is splittable although gzip is not. A task takes a byte range of a file, looks for the gzip magic in it, and
decodes a candidate's first bytes: a member counts when its data begin with a WARC version line whose header block is
complete and names a record type and a length. A task owns the members that start inside its range and reads the last
one past the range's end; what starts before is the business of the task before.

Equal payloads (by SHA-1) of at least ``min_bytes`` are stored once: the page with the largest id is the ``response``,
the others are ``revisit`` records that refer to it and keep the payload's length and digest in their headers.

Defined results: a null payload is empty, a null URL is left out, and a null id is written as an empty one and smaller
than all others. Blanks and control characters of a URL are percent-encoded. Rows repeated with the same id and payload are repeated records of the same type. An empty table
gives no archives and no records. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac.llm import common
from ontarmac.session import cut, scratch_path

RANGE_BYTES = 16 << 20
CHUNK_BYTES = 128 << 10
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
RECORDS_SCHEMA = (
    "path string, offset long, page_id string, record_type string, refers_to string, url string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ---------------------------------------------------------------------------------------


def _gz(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record; a revisit (``refers_to`` given) has the HTTP head of its response only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        plain = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {plain}")
    if revisit:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str):
    """Writes a task's rows to one archive, under a new name until it is complete.

    A repeated attempt replaces the file of an earlier one; files of attempts that failed are not listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        started, stream, size, records = f"{root}/_{name}-{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            stream = stream or files.open_output_stream(started, compression=None)
            names = ("page_id", "url", "html", "digest", "refers_to")
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                for page_id, url, html, digest, to in zip(*(part.column(n).to_pylist() for n in names)):
                    member = _gz(record(page_id, url, html.encode(), digest, to))
                    stream.write(member)
                    size, records = size + len(member), records + 1
        if stream:
            stream.close()
            if files.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:
                files.delete_file(f"{root}/{name}")  # of an attempt whose task was lost
            files.move(started, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"path": [name], "length": [size], "records": [records]})

    return run


def _digests(texts: list[str]) -> dict[str, list]:
    return {"digest": [payload_digest(t.encode()) for t in texts]}


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write ``pages`` below ``folder`` (a URI all executors reach) and return the manifest.

    Digests are grouped first (combined before the shuffle), so only one row per payload meets; pages are then
    joined with them by digest. A payload that many pages share makes a large part there, which adaptive execution splits.
    """
    narrow = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), F.coalesce(pages[html_col], F.lit("")).alias("html")
    )
    digest = F.pandas_udf(lambda texts: texts.map(lambda t: payload_digest(t.encode())), "string")
    keyed = narrow.withColumn("digest", digest("html"))
    large = F.octet_length("html") >= min_bytes
    firsts = cut(
        narrow.filter(large)
        .select(digest("html").alias("digest"), "page_id")
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"))
    )
    to = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")) & F.col("response_id").isNotNull(), F.col("response_id"))
    typed = keyed.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", to.alias("refers_to"))
    return cut(typed.mapInArrow(_writer(folder), "path string, length long, records long"))


# --- reading ---------------------------------------------------------------------------------------


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _is_record(source, data: bytes) -> tuple[bool, bytes]:
    """Whether a gzip member with a WARC record starts at the first byte of ``data``; reads on where that is not yet plain."""
    while True:
        inflate = zlib.decompressobj(31)
        try:
            start = inflate.decompress(data, 2048)
            while b"\r\n\r\n" not in start and start[: len(VERSION)] == VERSION and inflate.unconsumed_tail:
                start += inflate.decompress(inflate.unconsumed_tail, len(start))
        except zlib.error:
            return False, data
        head, complete, _ = start.partition(b"\r\n\r\n")
        if len(start) >= len(VERSION) and not start.startswith(VERSION):
            return False, data
        if complete:
            return {"warc-type", "content-length", "warc-record-id"} <= _fields(head).keys(), data
        more = b"" if inflate.eof else source.read(CHUNK_BYTES)
        if not more:
            return False, data
        data += more


def _member(source, data: bytes) -> tuple[bytes, bytes, int]:
    """A member's content, the bytes read behind it, and its length; reads on where ``data`` ends within it."""
    inflate, parts, length = zlib.decompressobj(31), [], 0
    while True:
        parts.append(inflate.decompress(data))
        length += len(data) - len(inflate.unused_data)
        if inflate.eof:
            return b"".join(parts), inflate.unused_data, length
        data = source.read(CHUNK_BYTES)
        if not data:
            raise EOFError("the archive ends within a record")


def _page(fields: dict[str, str], name: str) -> str | None:
    value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
    return value or None


def parse_record(content: bytes) -> dict:
    """Fields of a decoded record; a response's digest and length come from its payload, a revisit's from its headers."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        size, digest, body = int(_fields(http)["content-length"]), stated, None
    else:
        size, digest = len(body), payload_digest(body)
        if stated and stated != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have the stated digest")
    url = fields.get("warc-target-uri")
    return {
        "page_id": _page(fields, "warc-record-id"),
        "record_type": kind,
        "refers_to": _page(fields, "warc-refers-to"),
        "url": url,
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": body,
    }


def scan_range(source, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """Offset and fields of each record that starts in ``[start, end)`` of an open file.

    Behind a record the next one is expected at once; elsewhere the magic is searched byte by byte. A record that is
    damaged or cut off stops the job.
    """
    source.seek(start)
    at, data = start, b""
    while at < end:
        found = data.find(MAGIC)
        if found < 0:
            keep = min(len(data), len(MAGIC) - 1)  # the magic may straddle two pieces
            at, data = at + len(data) - keep, data[len(data) - keep :]
            more = source.read(CHUNK_BYTES)
            if not more:
                return
            data += more
            continue
        at, data = at + found, data[found:]
        if at >= end:
            return
        good, data = _is_record(source, data)
        if not good:
            at, data = at + 1, data[1:]
            continue
        content, data, length = _member(source, data)
        yield at, parse_record(content)
        at += length


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        names = ["page_id", "record_type", "refers_to", "url", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), *zip(names, kinds)])

        def packed(rows):
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                rows, held = [], 0
                with files.open_input_file(os.path.join(root, path)) as source:
                    for offset, row in scan_range(source, start, end):
                        held += row["payload_bytes"]
                        if not with_payload:
                            row["payload"] = None
                        rows.append({"path": path, "offset": offset, **row})
                        if len(rows) >= 1000 or with_payload and held > 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                yield packed(rows)

    return run


def read_archives(
    files: DataFrame, folder: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True
) -> DataFrame:
    """All records of the archives in ``files`` (``path`` below ``folder``, ``length``), a task per few byte ranges."""
    ranges = files.select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    ).select("path", "start", F.least("length", F.col("start") + range_bytes).alias("end"))
    return ranges.repartition("path", "start").mapInArrow(_reader(folder, with_payload), RECORDS_SCHEMA)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``length`` of the finished archives of a folder, without reading them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return listed.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), "length").filter("length > 0")


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, as a URI."""
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
