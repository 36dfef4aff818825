"""Listings, archive manifests, unpacking archives, and Parquet tables written and read back."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontarmac import constants as K
from ontarmac.checks import tables as T
from ontarmac.checks.feature_queries import feature_table
from ontarmac.operators import features as X, summaries
from ontarmac.plans import landing
from ontarmac.session import cut, scratch_path
from ontarmac.sources import archives as A, curated, listing, versions, zip_tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as in the archive source

OTHER_COLUMNS = [c for c in K.CURATED_COLUMNS if c not in ("Year", "Month")]


def listed(spark: SparkSession, folder: str) -> DataFrame:
    return listing.listed_files(T.listing_lines(spark, folder))


def paths(spark: SparkSession, folder: str) -> DataFrame:
    """One archive path per order; some are named like no monthly archive."""
    return T.table(spark, folder, "orders").selectExpr(
        "concat('file:/landing/', o_orderkey % 7, '/', case when o_orderkey % 53 = 0 then 'old_' else '' end,"
        " 'On_Time_Reporting_Carrier_On_Time_Performance_1987_present_', year(o_orderdate) + o_orderkey % 5, '_', month(o_orderdate),"
        " case when o_orderkey % 41 = 0 then '.zip.part' else '.zip' end) path",
        "o_orderkey length",
    )


def pending_months(spark: SparkSession, folder: str) -> DataFrame:
    """Listed months in which nothing was shipped yet."""
    months = A.one_per_month(A.in_months(A.manifest(paths(spark, folder)), "1995-03", "2004-06"))
    landed = T.table(spark, folder, "lineitem").selectExpr("year(l_shipdate) year", "month(l_shipdate) month")
    return A.pending(months, landed.distinct()).withColumn("target", A.target_path("/curated/"))


HEADER = ",".join(f'"{c}"' for c in K.CURATED_COLUMNS) + ","


def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All flights as lines in the public layout: quoted values, nothing for what is missing, a trailing comma."""

    def quoted(column: str) -> Column:
        value = F.replace(F.col(column).cast("string"), F.lit('"'), F.lit(""))
        return F.when(F.length(value) > 0, F.concat(F.lit('"'), value, F.lit('"'))).otherwise("")

    landed = T.landed_flights(spark, folder).withColumnsRenamed({"year": "Year", "month": "Month"})
    line = F.concat(F.concat_ws(",", *[quoted(c) for c in K.CURATED_COLUMNS]), F.lit(","))
    return landed.select("Year", "Month", line.alias("line"))


def archive_name(year: int, month: int) -> str:
    return f"On_Time_Reporting_Carrier_On_Time_Performance_1987_present_{year}_{month}.zip"


def write_archive(held, year: int, month: int, parts: Iterator[list[str]]) -> None:
    """A month's archive in the public layout, its lines deflated as they come; ``held`` need not be seekable."""
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("readme.html", "<p>about</p>")
        with archive.open(f"On_Time_{year}_{month}.CSV", "w", force_zip64=True) as member:
            member.write(f"{HEADER}\n".encode())
            for lines in parts:
                if lines:
                    member.write(("\n".join(lines) + "\n").encode())


def _zip_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One archive per month of each batch of lines."""
    for batch in batches:
        for (year, month), rows in batch.groupby(["Year", "Month"]):
            held = io.BytesIO()
            write_archive(held, year, month, iter([list(rows["line"])]))
            yield pd.DataFrame({"path": [f"file:/landing/{archive_name(year, month)}"], "content": [held.getvalue()]})


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """All flights packed into archives, in the form Spark reads binary files."""
    return csv_lines(spark, folder).mapInPandas(_zip_batches, "path string, content binary")


def _damaged_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Archives of May and October are cut off, those of March and August hold a second table."""
    for batch in _zip_batches(batches):
        path, content = batch.loc[0, "path"], batch.loc[0, "content"]
        month = int(path.removesuffix(".zip").rpartition("_")[2])
        if month in (3, 8):
            held = io.BytesIO(content)
            with zipfile.ZipFile(held, "a") as archive:
                archive.writestr("more.csv", "a,b")
            content = held.getvalue()
        yield pd.DataFrame({"path": [path], "content": [content[: len(content) // 2] if month % 5 == 0 else content]})


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    packed = csv_lines(spark, folder).mapInPandas(_damaged_batches, "path string, content binary")
    return cut(A.inspect(packed))


def unzipped(spark: SparkSession, folder: str) -> DataFrame:
    return landing.curated_rows(archives(spark, folder), HEADER)


def zip_ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Flights, packed, unpacked, landed by month and read back."""
    root = scratch_path(spark, "curated")
    curated.write_curated(unzipped(spark, folder), root)
    return curated.read_curated(spark, root).select("year", "month", *OTHER_COLUMNS)


def archive_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives hold, per month; how many there are depends on batches, so they are merged."""
    report = A.manifest(damaged(spark, folder))
    return report.select("year", "month", "is_zip", "csv_members", "header").distinct()


def archive_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Inspected archives against a listing that gives the right size, a wrong one (July) or none (February)."""
    report = damaged(spark, folder).withColumn("path", F.concat(F.col("path"), F.lit("#"), F.monotonically_increasing_id()))
    report = cut(report)  # months may have several archives; each gets a name of its own
    name, month = F.regexp_extract("path", r"([^/]+)$", 1), F.regexp_extract("path", r"_(\d+)\.zip", 1).cast("int")
    listed = report.filter(month != 2).select(name.alias("filename"), (F.col("length") + (month == 7).cast("int")).alias("size_bytes"))
    checked = A.integrity(report, listed).withColumn("filename", F.regexp_replace("filename", "#.*", ""))
    over = (F.col("expected") - F.col("length")).alias("over")
    return checked.select("filename", over, "size_ok", "is_zip", "ok").distinct()


def _archive_folder(spark: SparkSession, folder: str) -> str:
    """Archives of all flights as files in the shared folder, one per month.

    A task reads the files of one month and deflates their lines as they come, so nothing is shuffled and no month is held.
    """
    target = scratch_path(spark, "archives")
    uri = target if target.startswith("file:") or "://" in target else f"file://{target}"
    lines = csv_lines(spark, folder)

    def write_month(year: int, month: int) -> None:
        name = archive_name(year, month)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = pafs.FileSystem.from_uri(uri)
            files.create_dir(root, recursive=True)
            with files.open_output_stream(f"{root}/{name}", compression=None) as stream:
                write_archive(stream, year, month, (b.column(0).to_pylist() for b in batches))
            yield pa.RecordBatch.from_pydict({"name": [name]})

        own = lines.filter((F.col("Year") == year) & (F.col("Month") == month)).select("line")
        own.coalesce(1).mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()

    months = lines.select("Year", "Month").dropna().distinct().collect()  # folder names
    with ThreadPoolExecutor(max(1, spark.sparkContext.defaultParallelism)) as threads:  # a job of one task per month
        waiting = [threads.submit(inheritable_thread_target(spark)(write_month), *month) for month in sorted(months)]
        for month in waiting:
            month.result()
    return target


def landing_status(spark: SparkSession, folder: str) -> DataFrame:
    """Landing the archives three times: up to 1997, then all that is new, then all from 1998 on once more."""
    raw, root = _archive_folder(spark, folder), scratch_path(spark, "curated")
    runs = [
        landing.land(spark, raw, root, end="1997-12"),
        landing.land(spark, raw, root),
        landing.land(spark, raw, root, start="1998-01", overwrite=True),
    ]
    landed = curated.read_curated(spark, root).groupBy("year", "month").agg(F.count("*").alias("flights"))
    named = [r.select(F.lit(i + 1).alias("run"), "year", "month", "status") for i, r in enumerate(runs)]
    return named[0].unionByName(named[1]).unionByName(named[2]).join(landed, ["year", "month"], "left")


def zip_source(spark: SparkSession, folder: str) -> DataFrame:
    """All archives read through the data source, each as far as its own reader has got."""
    blocks = zip_tables.read(spark, _archive_folder(spark, folder))
    return landing.parsed(blocks, HEADER).select("year", "month", *OTHER_COLUMNS)


def zip_source_months(spark: SparkSession, folder: str) -> DataFrame:
    """What the directories of some months' archives say; the others are not opened."""
    found = zip_tables.read(spark, _archive_folder(spark, folder), "directory")
    some = found.filter("year in (1996, 1999) and month >= 3 and month < 9")
    return some.select("year", "month", "is_zip", "csv_members", "header", (F.col("table_bytes") > F.length("header")).alias("has_rows"))


def landing_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Flights per month and origin state in each version of a root: up to 1998, then late ones only from 1998 on, then one more month."""
    landed = T.landed_flights(spark, folder)
    log = versions.VersionLog(spark, scratch_path(spark, "curated-versions"))
    log.write(landed.filter("year <= 1998"))
    log.write(landed.filter("year >= 1998 and ArrDel15 = '1.00'"))
    log.write(landed.filter("year = 1997 and month = 3").drop("OriginState"))  # a landing without a column
    counted = [
        log.read(n).groupBy("year", "month", "OriginState").agg(F.count("*").alias("flights")).withColumn("version", F.lit(n))
        for n in range(1, log.latest() + 1)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def partitioned_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    curated.write_features(feature_table(spark, folder), path)
    return curated.read_features(spark, path).select(*X.FEATURE_COLUMNS)


def pruned_read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month of one split and a window of years, from the partitioned table."""
    path = scratch_path(spark, "features")
    curated.write_features(feature_table(spark, folder), path)
    window = X.year_window(X.of_split(curated.read_features(spark, path), "train"), 1997, 1998)
    return window.groupBy("year", "month").agg(F.count("*").alias("flights"), F.sum("label_delay_15").alias("late"))


QUERIES = {
    "listing_files": listed,
    "listing_best_per_month": lambda s, d: listing.best_per_month(listed(s, d)),
    "listing_summary": lambda s, d: listing.file_summary(
        A.in_months(listing.best_per_month(listed(s, d)), "1996-01", "2000-12")
    ),
    "archive_manifest": lambda s, d: A.manifest(paths(s, d)),
    "manifest_summary": lambda s, d: A.month_summary(A.one_per_month(A.manifest(paths(s, d)))),
    "pending_months": pending_months,
    "archive_integrity": archive_integrity,
    "archive_report": archive_report,
    "zip_unpack": lambda s, d: unzipped(s, d).select("year", "month", *OTHER_COLUMNS),
    "zip_ingest_roundtrip": zip_ingest_roundtrip,
    "partitioned_sink_roundtrip": partitioned_sink_roundtrip,
    "landing_status": landing_status,
    "landing_versions": landing_versions,
    "zip_source": zip_source,
    "zip_source_months": zip_source_months,
    "pruned_read": pruned_read,
    "sink_split_counts": lambda s, d: summaries.split_counts(partitioned_sink_roundtrip(s, d)),
}

# an entry taken apart at its blanks and quotes: date, time, half of the day, size, link
_LISTED_SQL = T.LISTING_SQL + """,
parts AS (SELECT list_filter(string_split(split_part(line, '<A', 1), ' '), lambda x: x <> '') AS p,
    list_reverse(string_split(split_part(line, '"', 2), '/'))[1] AS filename FROM lines),
named AS (SELECT *, string_split(replace(filename, '.zip', ''), '_') AS n FROM parts WHERE ends_with(filename, '.zip')),
listed AS (SELECT filename, cast(n[-2] AS integer) AS year, cast(n[-1] AS integer) AS month, cast(p[4] AS bigint) AS size_bytes,
    strptime(p[1] || ' ' || p[2] || ' ' || p[3], '%-m/%-d/%Y %-I:%M %p') AS listed_at FROM named),
best AS (SELECT year, month, filename, size_bytes, listed_at FROM (SELECT *, row_number() OVER (
    PARTITION BY year, month ORDER BY contains(filename, '('), size_bytes DESC, listed_at DESC, filename) AS rn FROM listed)
  WHERE rn = 1)"""

_PATHS_SQL = r"""
paths AS (SELECT concat('file:/landing/', o_orderkey % 7, '/', CASE WHEN o_orderkey % 53 = 0 THEN 'old_' ELSE '' END,
    'On_Time_Reporting_Carrier_On_Time_Performance_1987_present_', year(o_orderdate) + o_orderkey % 5, '_', month(o_orderdate),
    CASE WHEN o_orderkey % 41 = 0 THEN '.zip.part' ELSE '.zip' END) AS path, o_orderkey AS length FROM orders),
named AS (SELECT *, regexp_extract(path, '([^/]+)$', 1) AS filename FROM paths),
manifest AS (SELECT *, cast(regexp_extract(filename, '_(\d{4})_(\d{1,2})\.zip$', 1) AS integer) AS year,
    cast(regexp_extract(filename, '_(\d{4})_(\d{1,2})\.zip$', 2) AS integer) AS month
  FROM named WHERE regexp_matches(filename, '^On_Time_Reporting_Carrier_On_Time_Performance_1987_present_\d{4}_\d{1,2}\.zip$'))"""

_OTHER_SQL = ", ".join(f'"{c}"' for c in OTHER_COLUMNS)
_LANDED_SQL = f"""WITH {T.FLIGHTS_SQL} SELECT cast("Year" AS integer) AS year, cast("Month" AS integer) AS month,
  {_OTHER_SQL} FROM flights"""

ORACLES = {
    "listing_files": f"WITH {_LISTED_SQL} SELECT * FROM listed",
    "listing_best_per_month": f"WITH {_LISTED_SQL} SELECT * FROM best",
    "listing_summary": f"""WITH {_LISTED_SQL} SELECT count(*) AS files, arg_min(filename, year * 100 + month) AS first_file,
      arg_max(filename, year * 100 + month) AS latest_file, min(year * 100 + month) AS first_month,
      max(year * 100 + month) AS latest_month FROM best WHERE year * 100 + month BETWEEN 199601 AND 200012""",
    "archive_manifest": f"WITH {_PATHS_SQL} SELECT * FROM manifest",
    "manifest_summary": f"""WITH {_PATHS_SQL} SELECT count(*) AS months, min(year * 100 + month) AS first_month,
      max(year * 100 + month) AS last_month FROM (SELECT DISTINCT year, month FROM manifest)""",
    "pending_months": f"""WITH {_PATHS_SQL},
      firsts AS (SELECT year, month, path, length, filename FROM (SELECT *, row_number() OVER (
        PARTITION BY year, month ORDER BY path, length) AS rn FROM manifest
        WHERE year * 100 + month BETWEEN 199503 AND 200406) WHERE rn = 1)
      SELECT *, concat('/curated/year=', year, '/month=', lpad(month::varchar, 2, '0')) AS target FROM firsts f
      WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE year(l_shipdate) = f.year AND month(l_shipdate) = f.month)""",
    "archive_integrity": f"""WITH {T.FLIGHTS_SQL}, months AS (SELECT DISTINCT cast("Year" AS int) AS y, cast("Month" AS int) AS m FROM flights)
      SELECT 'On_Time_Reporting_Carrier_On_Time_Performance_1987_present_' || y || '_' || m || '.zip' AS filename,
        CASE WHEN m <> 2 THEN cast(CASE WHEN m = 7 THEN 1 ELSE 0 END AS bigint) END AS over, m <> 7 AS size_ok,
        m NOT IN (5, 10) AS is_zip, m NOT IN (5, 7, 10) AS ok FROM months""",
    "archive_report": f"""WITH {T.FLIGHTS_SQL}, months AS (SELECT DISTINCT cast("Year" AS integer) AS year, cast("Month" AS integer) AS month
      FROM flights) SELECT year, month, month NOT IN (5, 10) AS is_zip,
      cast(CASE WHEN month IN (5, 10) THEN 0 WHEN month IN (3, 8) THEN 2 ELSE 1 END AS integer) AS csv_members,
      CASE WHEN month NOT IN (3, 5, 8, 10) THEN '{HEADER}' END AS header FROM months""",
    "landing_status": f"""WITH {T.FLIGHTS_SQL}, months AS (SELECT cast("Year" AS integer) AS year, cast("Month" AS integer) AS month,
        count(*) AS flights FROM flights GROUP BY ALL),
      runs AS (SELECT 1 AS run, year, month, CASE WHEN year <= 1997 THEN 'ok' ELSE 'out of range' END AS status, flights FROM months
        UNION ALL SELECT 2, year, month, CASE WHEN year <= 1997 THEN 'skip' ELSE 'ok' END, flights FROM months
        UNION ALL SELECT 3, year, month, CASE WHEN year <= 1997 THEN 'out of range' ELSE 'replaced' END, flights FROM months)
      SELECT run, year, month, status, flights FROM runs""",
    "landing_versions": f"""WITH {T.FLIGHTS_SQL}, f AS (SELECT cast("Year" AS integer) AS year, cast("Month" AS integer) AS month,
        "OriginState", "ArrDel15" = '1.00' AS late FROM flights),
      held AS (SELECT 1 AS version, year, month, "OriginState" FROM f WHERE year <= 1998
        UNION ALL SELECT v, year, month, CASE WHEN v < 3 OR year <> 1997 OR month <> 3 THEN "OriginState" END
          FROM f, (VALUES (2), (3)) AS t(v) WHERE year < 1998 OR late)
      SELECT version, year, month, "OriginState", count(*) AS flights FROM held GROUP BY ALL""",
    "zip_unpack": _LANDED_SQL,
    "zip_source": _LANDED_SQL,
    "zip_source_months": f"""WITH {T.FLIGHTS_SQL} SELECT DISTINCT cast("Year" AS integer) AS year, cast("Month" AS integer) AS month,
      true AS is_zip, 1 AS csv_members, '{HEADER}' AS header, true AS has_rows FROM flights
      WHERE "Year" IN ('1996', '1999') AND cast("Month" AS integer) BETWEEN 3 AND 8""",
    "zip_ingest_roundtrip": _LANDED_SQL,
    "partitioned_sink_roundtrip": f"WITH {T.FEATURES_SQL} SELECT * FROM features",
    "pruned_read": f"""WITH {T.FEATURES_SQL} SELECT year, month, count(*) AS flights,
      cast(sum(label_delay_15) AS bigint) AS late FROM features WHERE split = 'train' AND year BETWEEN 1997 AND 1998
      GROUP BY year, month""",
    "sink_split_counts": f"""WITH {T.FEATURES_SQL} SELECT split, count(*) AS count FROM features GROUP BY split""",
}
