"""Archives as a data source."""

import zipfile

import pytest

from ontarmac.plans import landing
from ontarmac.sources import archives as A, curated, zip_tables as Z
from tests.test_landing import HEADER, NAME, counts, lines, put, raw  # noqa: F401


def text_of(df):
    rows = sorted(df.collect(), key=lambda r: (r["path"], r["block"]))
    out = {}
    for r in rows:
        out[r["year"], r["month"]] = out.get((r["year"], r["month"]), "") + r["text"]
    return out


def test_blocks_are_those_of_the_other_way(spark, raw):  # noqa: F811
    blocks = Z.read(spark, str(raw))
    assert blocks.rdd.getNumPartitions() == 3  # one per monthly archive; other files are not opened
    named = A.read_archives(spark, str(raw)).filter("path like '%present_%'")
    assert text_of(blocks) == text_of(A.manifest(A.unpack(named)))


def test_blocks_hold_whole_lines(spark, raw):  # noqa: F811
    Z.register(spark)
    small = spark.read.format(Z.NAME).option("block_bytes", 16).load(str(raw))
    assert small.filter("block > 2").count() > 0
    assert all(r["text"].endswith("\n") for r in small.collect()) and text_of(small) == text_of(Z.read(spark, str(raw)))


@pytest.mark.parametrize(("condition", "archives"), [
    ("year = 2024 and month = 1", 1), ("month in (1, 12)", 2), ("year > 2023", 2), ("year >= 2023 and year < 2024", 1),
    ("month <= 2 and length(text) > 0", 2), ("year = 1990", 0), ("year = 2024 or month = 12", 3),
])
def test_filters_on_months_leave_archives_out(spark, raw, condition, archives):  # noqa: F811
    (raw / f"{NAME}_1999_1.zip").write_bytes(b"not opened where it is left out")
    expected = text_of(Z.read(spark, [str(p) for p in sorted(raw.glob(f"{NAME}_202*.zip"))]).filter(condition))
    found = Z.read(spark, str(raw)).filter("year > 2000").filter(condition)
    assert found.rdd.getNumPartitions() in (archives, max(archives, 1))
    assert text_of(found) == expected


def test_patterns_lists_and_single_files(spark, raw):  # noqa: F811
    assert set(text_of(Z.read(spark, f"{raw}/*_2024_*.zip"))) == {(2024, 1), (2024, 2)}
    assert set(text_of(Z.read(spark, f"file:{raw}/{NAME}_2024_1.zip"))) == {(2024, 1)}
    assert set(text_of(Z.read(spark, [f"file:{raw}/{NAME}_2024_1.zip", f"{raw}/{NAME}_2023_12.zip"]))) == {(2024, 1), (2023, 12)}
    for wrong, message in ((f"{raw}/none", "none"), ([f"{raw}/old.zip"], "not named like")):
        with pytest.raises(Exception, match=message):
            Z.read(spark, wrong).collect()
    with pytest.raises(Exception, match="choose from"):
        Z.read(spark, str(raw), "other").collect()


def test_directories_say_what_inspecting_whole_files_says(spark, raw):  # noqa: F811
    put(raw, 2022, 1, HEADER, extra=("y.CSV",))
    put(raw, 2022, 2, HEADER, member="x.txt")
    (raw / f"{NAME}_2022_3.zip").write_bytes(b"PK not really")
    whole = (raw / f"{NAME}_2024_1.zip").read_bytes()
    (raw / f"{NAME}_2022_4.zip").write_bytes(whole[: len(whole) // 2])
    (raw / f"{NAME}_2022_5.zip").write_bytes(b"")
    columns = ["path", "length", "is_zip", "csv_members", "header"]
    found = {r["path"].split("/")[-1]: tuple(r)[1:] for r in Z.read(spark, str(raw), "directory").select(*columns).collect()}
    other = A.inspect(A.read_archives(spark, str(raw)).filter("path like '%present_%'"))
    assert found.pop(f"{NAME}_2022_5.zip") == (0, False, 0, None)  # an empty file gives no binaryFile row at all
    assert found == {r["path"].split("/")[-1]: tuple(r)[1:] for r in other.select(*columns).collect()}
    assert len(found) == 7
    with pytest.raises(Exception, match="one table is expected in an archive, not 2"):
        Z.read(spark, f"{raw}/*_2022_1.zip").collect()


def test_archives_beyond_two_gibibytes(spark, tmp_path):
    """Offsets and sizes as in large archives: a hole of 5 GiB stands before the members, so they need 64-bit fields."""
    folder = tmp_path / "raw"
    folder.mkdir()
    with open(folder / f"{NAME}_2024_1.zip", "w+b") as held:
        held.truncate(5 << 30)
        held.seek(0, 2)
        with zipfile.ZipFile(held, "a", zipfile.ZIP_DEFLATED) as archive:
            with archive.open("x.csv", "w", force_zip64=True) as member:
                member.write((HEADER + lines(2024, 1, 3000)).encode())
    assert (folder / f"{NAME}_2024_1.zip").stat().st_size > 5 << 30
    row = Z.read(spark, str(folder), "directory").first()
    assert row["length"] > 5 << 30 and row["is_zip"] and row["csv_members"] == 1 and row["header"] == HEADER.strip()
    root = str(tmp_path / "curated")
    landing.land(spark, str(folder), root)
    assert counts(spark, root) == {(2024, 1): 3000}


def test_stores_that_only_spark_opens_are_read_the_other_way(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    assert Z.opens(str(raw)) and Z.opens(f"file:{raw}") and not Z.opens("viewfs://cluster/raw")
    roots = [str(tmp_path / name) for name in ("seeking", "whole")]
    landing.land(spark, str(raw), roots[0])
    monkeypatch.setattr(Z, "opens", lambda path: False)
    landing.land(spark, str(raw), roots[1])
    a, b = (curated.read_curated(spark, r).select("year", "month", "Origin", "Note", "Extra").collect() for r in roots)
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 10


def test_empty_lists(spark, tmp_path):
    assert Z.read(spark, str(tmp_path)).count() == 0
    assert Z.read(spark, []).count() == 0
