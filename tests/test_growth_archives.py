"""Archives are packed a few lines at a time."""

import zipfile
from pathlib import Path

from ontarmac.checks import archive_queries as Q, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_archives_are_written_as_lines_come(tmp_path):
    def parts():
        for i in range(3):
            yield [f'"{i}",', f'"{i}",']

    with (tmp_path / "a.zip").open("wb") as file:
        Q.write_archive(file, 2020, 3, parts())
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        text = archive.read("On_Time_2020_3.CSV").decode()
    assert text.splitlines() == [Q.HEADER, *[f'"{i}",' for i in (0, 0, 1, 1, 2, 2)]] and text.endswith("\n")


def test_months_are_packed_without_a_shuffle_or_a_group(spark, folder):
    lines = Q.csv_lines(spark, folder)
    assert "Exchange" not in plan(lines)
    target = Q._archive_folder(spark, folder)
    flights = tables.landed_flights(spark, folder).groupBy("year", "month").count().collect()
    names = {Q.archive_name(r["year"], r["month"]): r["count"] for r in flights}
    found = {p.name: p for p in Path(target.removeprefix("file://").removeprefix("file:")).glob("*.zip")}
    assert set(found) == set(names)
    for name, path in list(found.items())[:5]:
        with zipfile.ZipFile(path) as archive:
            member = next(n for n in archive.namelist() if n.endswith(".CSV"))
            assert len(archive.read(member).decode().splitlines()) == names[name] + 1
