"""Parquet tables: curated flights by month and features by split and month."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ontarmac import constants as K
from ontarmac.session import freeing_shuffles, without_sorting
from ontarmac.sources import schemas, versions
from ontarmac.sources.storage import Folder


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated flights of a root, a year or a month; year and month stay columns for each of them.

    Archives of different months may have different headers, so the columns of all landings are taken together; a
    month without a column has NULL there. The columns are those registered beside the files (see :mod:`schemas`), so no
    footer is opened to plan the read; only a folder without a register is read by its footers. Of a root with versions
    the latest is read.
    """
    root = re.split(r"/(?:year|month)=", path.rstrip("/"))[0]
    if versions.is_versioned(spark, root):
        year, month = (re.search(rf"/{part}=(\d+)", path) for part in ("year", "month"))
        return versions.VersionLog(spark, root).read(None, *(int(m[1]) if m else None for m in (year, month)))
    known = schemas.registered(spark, root)
    if not known:
        return spark.read.option("basePath", root).option("mergeSchema", True).parquet(path)
    fields = [*schemas.union(known).fields, *versions.PARTITIONS[1:]]
    return spark.read.schema(StructType(fields)).option("basePath", root).parquet(path)


def write_curated(flights: DataFrame, root: str) -> None:
    """Replace the months present in ``flights``, and only those, one by one (:class:`versions.VersionLog` replaces all or none).

    ``year`` and ``month`` become folders. The source columns that differ from them in case only are left
    out; reading gives them back from the folder names. The columns are registered before the files are there.
    """
    spark = flights.sparkSession
    columns = StructType([f for f in flights.schema.fields if f.name not in ("year", "month")])
    if not schemas.registered(spark, root) and any(n.startswith("year=") for n in Folder(spark, root).names()):
        there = spark.read.option("mergeSchema", True).parquet(root).drop("year", "month")
        schemas.register(spark, root, there.schema)  # files from before there was a register
    schemas.register(spark, root, columns)
    padded = flights.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    with without_sorting(spark), freeing_shuffles(spark):
        (
            padded.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy("year", "month")
            .parquet(root)
        )


def write_features(
    features: DataFrame, path: str, overwrite: bool = False, rebalance: bool = False, watch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Write a feature table by split, year and month.

    Flights read from monthly folders need no shuffle: a task holds parts of few months, so there are about as
    many files as input parts. For other inputs ``rebalance`` brings months together first, and splits a month
    that holds much of the data over several tasks. ``watch`` is put on the rows as they are written, behind that shuffle, so
    that what it counts does not count a part again that is shuffled again.
    """
    laid_out = features.hint("rebalance", "split", "year", "month") if rebalance else features
    with without_sorting(features.sparkSession), freeing_shuffles(features.sparkSession):
        (
            (watch(laid_out) if watch else laid_out).write.mode("overwrite" if overwrite else "errorifexists")
            .option("compression", "snappy")
            .partitionBy("split", "year", "month")
            .parquet(path)
        )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def preview(flights: DataFrame, rows: int = 5, wanted: list[str] = K.PREVIEW_COLUMNS) -> DataFrame:
    """The first few rows, in the order of their values, of the wanted columns that exist, else of all columns."""
    present = {c.lower() for c in flights.columns}
    shown = [c for c in wanted if c.lower() in present] or flights.columns
    return flights.select(*shown).orderBy(*[F.asc_nulls_last(c) for c in shown]).limit(rows)


def table_shape(flights: DataFrame) -> dict:
    return {"columns": len(flights.columns), "first_columns": flights.columns[:10]}


def write_report(report: DataFrame, path: str, overwrite: bool = False) -> None:
    """A small report as JSON lines."""
    report.write.mode("overwrite" if overwrite else "errorifexists").json(path)
