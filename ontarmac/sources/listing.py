"""Directory listings of monthly archives."""

from __future__ import annotations

import html
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontarmac import constants as K
from ontarmac.functions.casts import as_column

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as in the archive source

# fixed value: one listing entry
ENTRY = rf'(?i)(\d{{1,2}}/\d{{1,2}}/\d{{4}}\s+\d{{1,2}}:\d{{2}}\s+[AP]M)\s+(\d+)\s+<A\s+HREF="(?:/PREZIP/)?({K.LISTED_NAME})"'


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing pages, one row per file: an index page of one directory is small."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "line")


def _plain(lines: pd.Series) -> pd.Series:
    return lines.map(html.unescape, na_action="ignore")


def _unescaped(column: str | Column) -> Column:
    """Text with its character references undone; blanks that do not break count as blanks."""
    text = as_column(column)
    undone = F.when(text.contains("&"), F.pandas_udf(_plain, "string")(text)).otherwise(text)
    return F.replace(undone, F.lit("\u00a0"), F.lit(" "))


def listed_files(pages: DataFrame, column: str = "line") -> DataFrame:
    """Every archive a listing names: file name, year, month, size and time of listing."""
    entry = F.col("entry")
    stamp = F.regexp_replace(F.upper(F.regexp_extract(entry, ENTRY, 1)), r"\s+", " ")
    return (
        pages.select(F.explode(F.regexp_extract_all(_unescaped(column), F.lit(ENTRY), F.lit(0))).alias("entry"))
        .select(
            F.regexp_extract(entry, ENTRY, 3).alias("filename"),
            F.regexp_extract(entry, ENTRY, 4).cast("int").alias("year"),
            F.regexp_extract(entry, ENTRY, 5).cast("int").alias("month"),
            F.regexp_extract(entry, ENTRY, 2).cast("bigint").alias("size_bytes"),
            F.to_timestamp_ntz(stamp, F.lit("M/d/yyyy h:mm a")).alias("listed_at"),
        )
    )


def best_per_month(files: DataFrame) -> DataFrame:
    """One file per month: plain names before those in brackets, then the largest, latest, first by name.

    An aggregate rather than a ranking window, so a month listed very often is reduced before the shuffle.
    """
    score = F.struct(
        F.col("filename").contains("(").alias("bracketed"),
        (-F.col("size_bytes")).alias("smaller"),
        (-F.unix_seconds(F.col("listed_at").cast("timestamp"))).alias("older"),
        "filename",
        "listed_at",
    )
    return (
        files.groupBy("year", "month")
        .agg(F.min(score).alias("best"))
        .select(
            "year",
            "month",
            "best.filename",
            (-F.col("best.smaller")).alias("size_bytes"),
            "best.listed_at",
        )
    )


def file_summary(files: DataFrame) -> DataFrame:
    """How many months there are, the first and the last of them."""
    ym = F.col("year") * 100 + F.col("month")
    return files.agg(
        F.count("*").alias("files"),
        F.min_by("filename", F.struct(ym, "filename")).alias("first_file"),
        F.max_by("filename", F.struct(ym, "filename")).alias("latest_file"),
        F.min(ym).alias("first_month"),
        F.max(ym).alias("latest_month"),
    )
