"""WARC: round trips, every cut into byte ranges, false magic, damage, odd rows."""

import io

import pyarrow as pa
import pytest

from ontarmac.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"
HTML = ["<p>a</p>", "", None, "é" * 5000, "x" * 400_000, "<p>a</p>", "", "\r\n\r\nWARC/1.1\r\n\r\n", "".join(chr(33 + i * 7 % 90) for i in range(60_000))]


def archive():
    parts = [warc._gz(warc.record(i, f"http://a/{i}", (h or "").encode(), warc.payload_digest((h or "").encode()))) for i, h in enumerate(HTML)]
    parts[3:3] = [b"junk \x1f\x8b\x08 more", warc.MAGIC, warc._gz(b"not a record"), b"\0" * 300_000]
    return b"".join(parts)


@pytest.mark.parametrize("step", [1, 17, 1000, 1 << 20])
def test_ranges_own_each_record_once(step):
    data = archive()
    step = max(step, len(data) // 400)
    found = []
    for start in range(0, len(data), step):
        found += [(at, r["page_id"]) for at, r in warc.scan_range(io.BytesIO(data), start, min(start + step, len(data)))]
    assert [p for _, p in found] == [str(i) for i in range(len(HTML))]
    assert found == [(at, r["page_id"]) for at, r in warc.scan_range(io.BytesIO(data), 0, len(data))]


def test_long_headers_and_cut_records():
    url = "http://a/" + "".join(chr(97 + i * i % 26) for i in range(400_000)) + " \r\nX: y"
    data = warc._gz(warc.record(1, url, b"z", warc.payload_digest(b"z")))
    ((_, row),) = warc.scan_range(io.BytesIO(data), 0, len(data))
    assert row["url"] == url.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A") and row["payload"] == b"z"
    with pytest.raises(EOFError):
        list(warc.scan_range(io.BytesIO(archive()[:-50]), 0, len(archive())))


def test_round_trip(spark):
    rows = [(i, None if i == 1 else f"http://a/{i}?ü", h, "clash") for i, h in enumerate(HTML)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folder = warc.archive_folder(spark)
    files = warc.write_archives(pages, folder)
    assert sorted(map(tuple, files.select("path", "length").collect())) == sorted(map(tuple, warc.list_archives(spark, folder).collect()))
    got = {r["page_id"]: r for r in warc.read_archives(files, folder, range_bytes=1000).collect()}
    last = {}
    for i, h in enumerate(HTML):
        last[h or ""] = i
    for i, h in enumerate(HTML):
        r, body = got.pop(str(i)), (h or "").encode()
        assert (r["payload_bytes"], r["payload_digest"], r["url"]) == (len(body), warc.payload_digest(body), rows[i][1])
        if last[h or ""] == i:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, body)
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", str(last[h or ""]), None)
    assert not got


def test_small_payloads_stay_whole_and_odd_rows(spark):
    folder = warc.archive_folder(spark)
    pages = spark.createDataFrame([(1, "u", "ab", None), (2, "u", "ab", None), (None, "u", "long text", None), (3, "u", "long text", None), (3, "u", "long text", None)], SCHEMA)
    files = warc.write_archives(pages, folder, min_bytes=5)
    rows = warc.read_archives(files, folder, with_payload=False).collect()
    got = sorted((r["page_id"] or "", r["record_type"], r["refers_to"] or "") for r in rows)
    assert got == [("", "revisit", "3"), ("1", "response", ""), ("2", "response", ""), ("3", "response", ""), ("3", "response", "")]
    none = warc.write_archives(spark.createDataFrame([], SCHEMA), warc.archive_folder(spark))
    assert none.count() == 0 and warc.read_archives(none, folder).count() == 0
