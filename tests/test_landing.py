import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ontarmac.plans import building, landing
from ontarmac.sources import archives as A, curated, listing
from ontarmac.streaming import arrivals

NAME = "On_Time_Reporting_Carrier_On_Time_Performance_1987_present"
HEADER = '"Year","Month","Origin","Note",\r\n'


def put(folder, year, month, text, member="x.CSV", extra=()):
    path = folder / f"{NAME}_{year}_{month}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("readme.html", "about")
        archive.writestr(member, text)
        for name in extra:
            archive.writestr(name, text)
    return path


def lines(year, month, n):
    return "".join(f'{year},{month},"A{i}","say é, ok",\r\n' if i % 2 else f"{year},{month},B{i},,\r\n" for i in range(n))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    put(folder, 2024, 1, HEADER + lines(2024, 1, 5))
    put(folder, 2024, 2, "﻿\r\n" + HEADER + "\r\n" + lines(2024, 2, 3) + "\r\n")
    put(folder, 2023, 12, '"Origin","Extra"\n"C1","e"\n"C2",""\n')
    (folder / f"{NAME}_2024_3.zip.part").write_bytes(b"half")
    (folder / "old.zip").write_bytes(b"none of ours")
    return folder


def counts(spark, root):
    return {(r["year"], r["month"]): r["count"] for r in spark.read.parquet(root).groupBy("year", "month").count().collect()}


@pytest.mark.parametrize("hot_bytes", [A.HOT_ARCHIVE_BYTES, 0])
def test_land(spark, raw, tmp_path, hot_bytes):
    root = str(tmp_path / "curated")
    done = landing.land(spark, str(raw), root, hot_bytes=hot_bytes).collect()
    assert [(r["year"], r["month"], r["status"]) for r in done] == [(2023, 12, "ok"), (2024, 1, "ok"), (2024, 2, "ok")]
    assert done[1]["target"] == f"{root}/year=2024/month=01"
    assert counts(spark, root) == {(2023, 12): 2, (2024, 1): 5, (2024, 2): 3}
    landed = curated.read_curated(spark, root)
    assert set(landed.columns) == {"Origin", "Note", "Extra", "year", "month"}
    rows = {r["Origin"]: (r["Note"], r["Extra"]) for r in landed.filter("year = 2024 and month = 1").collect()}
    assert rows["B0"] == (None, None) and len(rows) == 5
    assert {r["Extra"] for r in landed.filter("Origin like 'C%'").collect()} == {"e", None}


def test_values_match_the_csv_reader(spark, raw, tmp_path):
    root = str(tmp_path / "curated")
    landing.land(spark, str(raw), root)
    (tmp_path / "plain.csv").write_text(HEADER + lines(2024, 1, 5), encoding="utf-8", newline="")
    expected = spark.read.csv(str(tmp_path / "plain.csv"), header=True, mode="FAILFAST").select("Origin", "Note")
    got = curated.read_curated(spark, f"{root}/year=2024/month=01").select("Origin", "Note")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_only_new_months_are_landed(spark, raw, tmp_path):
    root = str(tmp_path / "curated")
    landing.land(spark, str(raw), root, "2024-01", "2024-01")
    put(raw, 2024, 1, HEADER + lines(2024, 1, 9))
    done = landing.land(spark, str(raw), root, "2024-01", "2024-12").collect()
    assert [r["status"] for r in done] == ["out of range", "skip", "ok"]
    assert counts(spark, root) == {(2024, 1): 5, (2024, 2): 3}
    landing.land(spark, str(raw), root, "2024-01", "2024-01", overwrite=True)
    assert counts(spark, root) == {(2024, 1): 9, (2024, 2): 3}
    done = landing.land(spark, str(raw), root, "2024-01", "2024-02").collect()
    assert [r["status"] for r in done] == ["out of range", "skip", "skip"]


@pytest.mark.parametrize(("year", "text", "member", "extra", "message"), [
    (2022, HEADER, "x.txt", (), "0"),
    (2022, HEADER, "x.csv", ("y.CSV",), "2"),
])
def test_archives_need_exactly_one_csv(spark, raw, tmp_path, year, text, member, extra, message):
    put(raw, year, 1, text, member, extra)
    with pytest.raises(ValueError, match=rf"1 archives .*2022_1.zip \({message} CSV files\)"):
        landing.land(spark, str(raw), str(tmp_path / "curated"))


def test_broken_archives_stop_the_job(spark, raw, tmp_path):
    (raw / f"{NAME}_2022_1.zip").write_bytes(b"PK not really")
    with pytest.raises(ValueError, match="not a ZIP"):
        landing.land(spark, str(raw), str(tmp_path / "curated"))


@pytest.mark.parametrize("bad", ["2022,1,X\r\n", "2022,1,X,y,,extra\r\n"])
def test_malformed_rows_stop_the_job(spark, raw, tmp_path, bad):
    put(raw, 2022, 1, HEADER + lines(2022, 1, 2) + bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.land(spark, str(raw), str(tmp_path / "curated"))


def test_nothing_to_land_is_an_error(spark, raw, tmp_path):
    done = landing.land(spark, str(raw), str(tmp_path / "curated"), "2001-01", "2001-02").collect()
    assert [r["status"] for r in done] == ["out of range"] * 3
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no archives"):
        landing.land(spark, str(tmp_path / "none"), str(tmp_path / "curated"))
    with pytest.raises(ValueError):
        landing.land(spark, str(raw), str(tmp_path / "curated"), "2001-02", "2001-01")


@pytest.mark.parametrize("month", ["2024-13", "2024-1", "24-01", "2024-00"])
def test_month_names(month):
    with pytest.raises(ValueError):
        A.year_month(month)


def test_blocks_hold_whole_lines(monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BYTES", 7)
    text = "a,b\r\n" + "".join(f"é{i},x\r\n" for i in range(50)) + "last,é"
    blocks = list(A.line_blocks(io.BytesIO(text.encode())))
    assert "".join(blocks) == text and len(blocks) > 10
    assert all(b.endswith("\n") for b in blocks[:-1])


def test_header_names():
    assert A.header_names('"Year","Div1,x",a,A,,') == ["Year", "Div1,x", "a2", "A3", "_c4", "_c5"]


def test_integrity(spark, raw):
    files = A.manifest(A.read_archives(spark, str(raw)))
    sizes = {r["filename"]: r["length"] for r in files.select("filename", "length").collect()}
    (raw / f"{NAME}_2022_1.zip").write_bytes(b"PK not really")
    listed = [(f"{NAME}_2024_1.zip", sizes[f"{NAME}_2024_1.zip"]), (f"{NAME}_2024_2.zip", 1)]
    checked = A.integrity(
        A.inspect(A.read_archives(spark, str(raw))), spark.createDataFrame(listed, "filename string, size_bytes bigint"))
    got = {r["filename"][-11:]: (r["size_ok"], r["is_zip"], r["ok"]) for r in checked.collect()}
    assert got == {"_2024_1.zip": (True, True, True), "_2024_2.zip": (False, True, False), "2023_12.zip": (True, True, True),
                   "_2022_1.zip": (True, False, False), "old.zip": (True, False, False)}


def test_listing_page(spark, tmp_path):
    short, long = f"{NAME}_2024_5.zip", NAME.replace("_1987_present", "_(1987_present)") + "_2024_5.zip"
    page = (
        '<pre><A HREF="/">up</A><br> 7/11/2024 12:05 AM     31000 <A HREF="/PREZIP/' + long + '">x</A><br>'
        ' 6/01/2024  1:05 PM     30000 <a href="' + short + '">x</a><br>\n'
        "12/31/2024 12:00 PM     29999 <A HREF=&quot;/PREZIP/" + short.replace("_", "&#95;") + "&#x22;>x</A><br>"
        ' 1/01/2024  1:00 AM   5 <A HREF="/PREZIP/other_2024_5.zip">x</A></pre>'
    )
    (tmp_path / "index.html").write_text(page)
    files = listing.listed_files(listing.read_listing(spark, str(tmp_path)))
    rows = {(r["filename"], r["size_bytes"]): str(r["listed_at"]) for r in files.collect()}
    assert rows == {(long, 31000): "2024-07-11 00:05:00", (short, 30000): "2024-06-01 13:05:00", (short, 29999): "2024-12-31 12:00:00"}
    best = listing.best_per_month(files).collect()
    assert [(r["year"], r["month"], r["filename"], r["size_bytes"]) for r in best] == [(2024, 5, short, 30000)]


def test_build_from_curated(spark, flights, tmp_path):
    """Curated flights to both feature tables, with the default split years moved over the test data."""
    moved = flights.withColumns({
        "Year": (F.col("Year").cast("int") + 24).cast("string"),
    }).filter("Year in ('2021', '2022', '2023', '2024')")
    root = str(tmp_path / "curated")
    curated.write_curated(moved.withColumnRenamed("Year", "year").withColumnRenamed("Month", "month"), root)
    split_rows = building.build_features(spark, root, str(tmp_path / "f")).collect()
    assert [r["split"] for r in split_rows] == ["test", "train", "valid"]
    assert building.build_history_features(spark, root, str(tmp_path / "h")).collect() == split_rows
    assert len(spark.read.parquet(str(tmp_path / "h")).columns) == 35
    small = building.build_history_features(spark, root, str(tmp_path / "d"), dev_subset=True).collect()
    assert 0 < sum(r["count"] for r in small) < 0.1 * sum(r["count"] for r in split_rows)


def test_arrivals(spark, raw, tmp_path):
    root, seen = str(tmp_path / "curated"), str(tmp_path / "seen")
    arrivals.land_arrivals(spark, str(raw), root, seen)
    assert counts(spark, root) == {(2023, 12): 2, (2024, 1): 5, (2024, 2): 3}
    put(raw, 2024, 3, HEADER + lines(2024, 3, 4))
    arrivals.land_arrivals(spark, str(raw), root, seen)
    assert counts(spark, root) == {(2023, 12): 2, (2024, 1): 5, (2024, 2): 3, (2024, 3): 4}


def test_header_names_may_hold_any_character(spark):
    block = [("p", 0, '"a b","c,d","e`f",g:h,\n1,2,3,4,\n')]
    rows = A.parse(spark.createDataFrame(block, A.BLOCK_SCHEMA), '"a b","c,d","e`f",g:h,', ["path"])
    assert rows.columns == ["path", "a b", "c,d", "e`f", "g:h"] and tuple(rows.first()) == ("p", "1", "2", "3", "4")


def test_late_months_land_by_default_and_every_archive_has_a_status(spark, raw, tmp_path):
    put(raw, 2026, 1, HEADER + lines(2026, 1, 2))
    (raw / "again").mkdir()
    put(raw / "again", 2024, 1, HEADER + lines(2024, 1, 7))
    files = A.read_archives(spark, [str(raw), str(raw / "again")])
    root = str(tmp_path / "curated")
    done = landing.land_files(files, root).collect()
    assert [(r["year"], r["month"], r["status"]) for r in done] == [
        (2023, 12, "ok"), (2024, 1, "ok"), (2024, 1, "skip"), (2024, 2, "ok"), (2026, 1, "ok")]
    again = [r["status"] for r in landing.land_files(files, root, "2024-01", overwrite=True).collect()]
    assert sorted(again) == ["out of range", "replaced", "replaced", "replaced", "skip"]
    arrivals.land_arrivals(spark, str(raw), str(tmp_path / "other"), str(tmp_path / "seen"))
    assert (2026, 1) in counts(spark, str(tmp_path / "other"))


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_months_with_different_headers_read_back_complete(spark, tmp_path, order):
    root = str(tmp_path / "curated")
    texts = {1: HEADER + lines(2025, 1, 3), 2: '"Origin","Extra"\n"C1","e"\n'}
    for month in order:
        folder = tmp_path / str(month)
        folder.mkdir()
        put(folder, 2025, month, texts[month])
        landing.land(spark, str(folder), root)
    read = curated.read_curated(spark, root)
    assert set(read.columns) == {"Origin", "Note", "Extra", "year", "month"}
    assert {(r["month"], r["Extra"]) for r in read.collect()} == {(1, None), (2, "e")}


def test_arrivals_replace_landed_months(spark, raw, tmp_path):
    root, seen = str(tmp_path / "curated"), str(tmp_path / "seen")
    arrivals.land_arrivals(spark, str(raw), root, seen)
    put(raw, 2024, "01", HEADER + lines(2024, 1, 9))
    arrivals.land_arrivals(spark, str(raw), root, seen, overwrite=True)
    assert counts(spark, root)[(2024, 1)] == 9


def test_lines_that_end_in_carriage_returns(monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BYTES", 16)
    text = "a,b\r" + "".join(f"{i},x\r" for i in range(200))
    blocks = list(A.line_blocks(io.BytesIO(text.encode())))
    assert "".join(blocks) == text and max(map(len, blocks)) < 64
