"""Landing monthly archives as curated Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac.session import cut, scratch_path
from ontarmac.sources import archives as A, curated, versions, zip_tables


def curated_rows(archives: DataFrame, header: str, spread: bool = False) -> DataFrame:
    """Rows of archives that share a header, with the year and month their file names give.

    Each archive is unpacked and parsed by one task. ``spread`` sends the text blocks of large archives
    to other tasks before parsing.
    """
    return parsed(A.manifest(A.unpack(archives)), header, spread)


def parsed(blocks: DataFrame, header: str, spread: bool = False) -> DataFrame:
    """Rows of text blocks that share a header and have a year and month."""
    if spread:
        blocks = blocks.repartition("path", "block")
    return A.parse(blocks, header, keep=["year", "month"])


def land(
    spark: SparkSession,
    input_dir: str,
    output_root: str,
    start: str | None = None,
    end: str | None = None,
    overwrite: bool = False,
    hot_bytes: int = A.HOT_ARCHIVE_BYTES,
    versioned: bool = False,
) -> DataFrame:
    """Convert the archives of all new months in one job; returns what was done with each archive.

    Without ``start`` or ``end`` that side is open. With ``overwrite`` months that exist are replaced. All archives are
    checked before any is converted. ``versioned`` lands all months or none, as a version of the root.
    """
    done = land_files(A.read_archives(spark, input_dir), output_root, start, end, overwrite, hot_bytes, versioned)
    if done.isEmpty():
        raise ValueError("no archives found")
    return done


def statuses(files: DataFrame, landed: DataFrame, start: str | None, end: str | None, overwrite: bool) -> DataFrame:
    """Every archive with its ``status``.

    ``out of range``: its month lies outside the bounds. ``skip``: its month has been landed, or an earlier archive of
    the month is taken (with ``overwrite`` the last one). ``ok`` and ``replaced``: to be landed, in the latter case over what
    is there.
    """
    listed = A.manifest(files.select("path", "length"))
    pick = F.max if overwrite else F.min
    chosen = A.in_months(listed, start, end).groupBy("year", "month").agg(pick("path").alias("chosen"))
    present = landed.withColumn("landed", F.lit(True))
    status = (
        F.when(~A.within_months(start, end), "out of range")
        .when(F.col("path") != F.col("chosen"), "skip")
        .when(F.col("landed").isNull(), "ok")
        .otherwise("replaced" if overwrite else "skip")
    )
    return (
        listed.join(chosen, ["year", "month"], "left")
        .join(present, ["year", "month"], "left")
        .select("year", "month", "path", "length", status.alias("status"))
    )


def land_files(
    files: DataFrame,
    output_root: str,
    start: str | None = None,
    end: str | None = None,
    overwrite: bool = False,
    hot_bytes: int = A.HOT_ARCHIVE_BYTES,
    versioned: bool = False,
) -> DataFrame:
    """:func:`land` for archives already listed; there may be none. A root with versions gets a further one."""
    spark = files.sparkSession
    log = versions.VersionLog(spark, output_root) if versioned or versions.is_versioned(spark, output_root) else None
    base = log.at() if log else None
    landed = log.months(base.number) if log else A.landed_months(spark, output_root)
    todo = cut(statuses(files, landed, start, end, overwrite).withColumn("target", A.target_path(output_root)))
    # file names only: the driver lists these files anyway to plan the scan
    pending = todo.filter("status in ('ok', 'replaced')").select("path", "length").collect()
    if pending:
        rows = checked_rows(spark, {row["path"]: row["length"] for row in pending}, hot_bytes)
        log.write(rows, base) if log else curated.write_curated(rows, output_root)
    return todo.select("year", "month", "path", "status", "target").orderBy("year", "month", "path")


def checked_rows(spark: SparkSession, lengths: dict[str, int], hot_bytes: int = A.HOT_ARCHIVE_BYTES) -> DataFrame:
    """The rows of archives, all of which are checked first. Archives with the same header are parsed together.

    Archives that tasks can open are read where they are (:mod:`zip_tables`), of any size; checking reads their
    directories and first lines. Those of stores that only Spark opens are ``binaryFile`` rows.

    Faulty archives stop the job; the message names the first of them and the table that holds the report on all.
    """
    seekable = zip_tables.opens(next(iter(lengths)))
    found = zip_tables.read(spark, list(lengths), "directory") if seekable else A.inspect(A.read_archives(spark, list(lengths)))
    checked = found.select("path", "is_zip", "csv_members", "header", F.xxhash64("header").alias("layout"))
    path = scratch_path(spark, "archive-report")
    checked.write.parquet(path)
    report = spark.read.parquet(path)
    bad = report.filter(~F.col("is_zip") | (F.col("csv_members") != 1)).select("path", "is_zip", "csv_members")
    first = bad.orderBy("path").first()
    if first:
        fault = f"{first['csv_members']} CSV files" if first["is_zip"] else "not a ZIP"
        raise ValueError(f"{bad.count()} archives without exactly one CSV file, as {first['path']} ({fault}); all are in {path}")
    headers = {r["layout"]: r["header"] for r in report.select("layout", "header").distinct().collect()}
    groups: dict[tuple[int, bool], list[str]] = {}
    for row in report.select("path", "layout").collect():
        groups.setdefault((row["layout"], lengths[row["path"]] > hot_bytes), []).append(row["path"])
    parts = [
        parsed(zip_tables.read(spark, paths), headers[layout], hot)
        if seekable
        else curated_rows(A.read_archives(spark, paths), headers[layout], hot)
        for (layout, hot), paths in sorted(groups.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
