"""Versions of a curated root, its register of columns, and the small files both are kept in."""

import threading

import pytest
from pyspark.sql.types import StructType

from ontarmac.plans import building, landing
from ontarmac.sources import curated, schemas, versions
from ontarmac.sources.storage import Folder
from tests.test_landing import HEADER, lines, put, raw  # noqa: F401

TABLE = "Origin string, Note string, year int, month int"


def flights(spark, *months, note="n", rows=2):
    return spark.createDataFrame([(f"A{i}", note, y, m) for y, m in months for i in range(rows)], TABLE)


def per_month(df):
    return {(r["year"], r["month"]): r["count"] for r in df.groupBy("year", "month").count().collect()}


@pytest.fixture
def log(spark, tmp_path):
    return versions.VersionLog(spark, str(tmp_path / "curated"))


def test_a_name_is_taken_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "small"))
    assert folder.names() == [] and folder.sizes("x") == {}
    assert folder.publish("a", "é1") and not folder.publish("a", "2")
    assert folder.read("a") == "é1" and folder.names() == ["a"]
    folder._link = folder._rename  # as on file systems without links
    assert folder.publish("b", "1") and not folder.publish("b", "2") and folder.read("b") == "1"
    won = []
    rivals = [threading.Thread(target=lambda i=i: won.append(Folder(spark, str(tmp_path / "small")).publish("c", str(i)))) for i in range(8)]
    for r in rivals:
        r.start()
    for r in rivals:
        r.join()
    assert sorted(won) == [False] * 7 + [True]


def test_versions_hold_what_was_committed(spark, log):
    assert log.at().number == 0 and log.read().count() == 0 and log.months().count() == 0
    log.write(flights(spark, (2023, 12), (2024, 1)))
    log.write(flights(spark, (2024, 1), (2024, 2), rows=5))
    assert per_month(log.read(1)) == {(2023, 12): 2, (2024, 1): 2}
    assert per_month(log.read()) == {(2023, 12): 2, (2024, 1): 5, (2024, 2): 5}
    assert per_month(log.read(year=2024, month=1)) == {(2024, 1): 5}
    assert [(h["version"], h["months"]) for h in log.history()] == [(1, 2), (2, 2)]
    assert sorted(tuple(r) for r in log.months(1).collect()) == [(2023, 12), (2024, 1)]
    with pytest.raises(ValueError, match="no version 3"):
        log.read(3)
    assert per_month(curated.read_curated(spark, f"{log.root}/year=2024/month=02")) == {(2024, 2): 5}
    assert set(curated.read_curated(spark, log.root).columns) == {"Origin", "Note", "year", "month"}


def test_snapshots_change_nothing(spark, log, monkeypatch):
    monkeypatch.setattr(versions, "SNAPSHOT_EVERY", 2)
    for k in range(5):
        log.write(flights(spark, (2024, k % 3 + 1), rows=k + 1))
    assert len(log._numbers("snapshot")) == 2
    whole = versions.Version()
    for n in range(1, 6):
        whole = whole.after(log._commit(n))
        assert log.at(n) == whole
    assert per_month(log.read()) == {(2024, 1): 4, (2024, 2): 5, (2024, 3): 3}


def test_a_run_that_is_lost_leaves_the_old_version(spark, log, monkeypatch):
    log.write(flights(spark, (2024, 1)))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions.VersionLog, "commit", lost)  # after all files are written
        with pytest.raises(KeyboardInterrupt):
            log.write(flights(spark, (2024, 1), (2024, 2), rows=9))
    assert per_month(log.read()) == {(2024, 1): 2} and log.latest() == 1
    left = {p for run in Folder(spark, log.root).names() if run.startswith("run=") for p in Folder(spark, log.root).sizes(run)}
    assert len(left) > len(log.at().files)
    assert log.clean() == []  # too young
    assert set(log.clean(older_than_hours=-1)) == left - set(log.at().files)
    assert per_month(log.read()) == {(2024, 1): 2}


def test_a_malformed_month_lands_nothing(spark, raw, tmp_path):  # noqa: F811
    root = str(tmp_path / "curated")
    landing.land(spark, str(raw), root, "2023-12", "2024-01", versioned=True)
    put(raw, 2024, 3, HEADER + lines(2024, 3, 4))
    put(raw, 2024, 4, HEADER + lines(2024, 4, 4) + "2024,4,X\r\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.land(spark, str(raw), root, versioned=True)
    assert per_month(curated.read_curated(spark, root)) == {(2023, 12): 2, (2024, 1): 5}
    put(raw, 2024, 4, HEADER + lines(2024, 4, 4))
    done = landing.land(spark, str(raw), root).collect()  # a root with versions gets a further one
    assert [r["status"] for r in done] == ["skip", "skip", "ok", "ok", "ok"]
    assert per_month(curated.read_curated(spark, root)) == {(2023, 12): 2, (2024, 1): 5, (2024, 2): 3, (2024, 3): 4, (2024, 4): 4}
    again = landing.land(spark, str(raw), root, "2024-01", "2024-01", overwrite=True).collect()
    assert [r["status"] for r in again].count("replaced") == 1
    assert versions.VersionLog(spark, root).latest() == 3


@pytest.mark.parametrize("other", [(2024, 2), (2024, 7)])
def test_of_two_runs_on_one_month_one_wins(spark, log, other):
    log.write(flights(spark, (2024, 1)))
    base, start, results = log.at(), threading.Barrier(2), {}

    def run(name, month, rows):
        start.wait()
        try:
            results[name] = versions.VersionLog(spark, log.root).write(flights(spark, month, (2024, 3 + rows), rows=rows), base).number
        except versions.LandingConflict as problem:
            results[name] = str(problem)

    both = [threading.Thread(target=run, args=a) for a in (("a", (2024, 2), 3), ("b", other, 5))]
    for t in both:
        t.start()
    for t in both:
        t.join()
    numbers = sorted(r for r in results.values() if isinstance(r, int))
    found = per_month(log.read())
    if other == (2024, 2):
        assert numbers == [2] and any("nothing was landed" in str(r) for r in results.values())
        assert found in ({(2024, 1): 2, (2024, 2): 3, (2024, 6): 3}, {(2024, 1): 2, (2024, 2): 5, (2024, 8): 5})
    else:
        assert numbers == [2, 3] and found == {(2024, 1): 2, (2024, 2): 3, (2024, 6): 3, (2024, 7): 5, (2024, 8): 5}


def test_columns_of_versions_are_taken_together(spark, log):
    log.write(flights(spark, (2024, 1)))
    log.write(spark.createDataFrame([("A1", "e", 2024, 2)], "ORIGIN string, Extra string, year int, month int"))
    assert log.read().columns == ["Origin", "Note", "Extra", "year", "month"]
    assert {tuple(r) for r in log.read().collect()} == {("A0", "n", None, 2024, 1), ("A1", "n", None, 2024, 1), ("A1", None, "e", 2024, 2)}
    with pytest.raises(ValueError, match="Note is int"):
        log.write(spark.createDataFrame([("A1", 1, 2024, 3)], "Origin string, Note int, year int, month int"))
    assert log.latest() == 2


def test_reading_opens_no_footers(spark, tmp_path):
    root = str(tmp_path / "curated")
    curated.write_curated(flights(spark, (2024, 1)), root)
    other = spark.createDataFrame([("B1", "e", 2024, 2)], "Origin string, Extra string, year int, month int")
    curated.write_curated(other, root)
    curated.write_curated(other, root)
    assert len(schemas.registered(spark, root)) == 2
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("registered", "read")
    read = curated.read_curated(spark, root)
    assert read.columns == ["Origin", "Note", "Extra", "year", "month"]
    assert list(tracker.getJobIdsForGroup("registered")) == []
    context.setJobGroup("merged", "read")
    spark.read.option("mergeSchema", True).parquet(root)
    assert len(tracker.getJobIdsForGroup("merged")) == 1  # what a read without a register takes
    context.setJobGroup("", "")
    assert {(r["month"], r["Note"], r["Extra"]) for r in read.collect()} == {(1, "n", None), (2, None, "e")}


def test_folders_from_before_the_register(spark, tmp_path):
    root = str(tmp_path / "curated")
    flights(spark, (2024, 1)).write.partitionBy("year", "month").parquet(root)
    assert set(curated.read_curated(spark, root).columns) == {"Origin", "Note", "year", "month"}
    curated.write_curated(spark.createDataFrame([("B1", "e", 2024, 2)], "Origin string, Extra string, year int, month int"), root)
    assert curated.read_curated(spark, root).columns == ["Origin", "Note", "Extra", "year", "month"]
    with pytest.raises(ValueError, match="Extra is int"):
        curated.write_curated(spark.createDataFrame([(1, 2024, 2)], "Extra int, year int, month int"), root)


def test_union_of_columns():
    a, b = (StructType.fromDDL(d) for d in ("x string, Y int", "y int, z string"))
    assert schemas.union([a, b]).names == ["x", "Y", "z"] and schemas.union([]) == StructType()


def test_features_are_built_from_a_version(spark, flights_moved, tmp_path):
    log = versions.VersionLog(spark, str(tmp_path / "curated"))
    log.write(flights_moved)
    plain = str(tmp_path / "plain")
    curated.write_curated(flights_moved, plain)
    expected = building.build_features(spark, plain, str(tmp_path / "a")).collect()
    assert building.build_features(spark, log.root, str(tmp_path / "b")).collect() == expected


@pytest.fixture
def flights_moved(spark, flights):
    from pyspark.sql import functions as F

    moved = flights.withColumn("Year", (F.col("Year").cast("int") + 24).cast("string")).filter("Year in ('2022', '2023', '2024')")
    return moved.withColumnsRenamed({"Year": "year", "Month": "month"})
