"""Indexes of text values that never meet on the driver.

``StringIndexer`` holds all values of a column in the model and on the driver. A dictionary is a table instead: a row per value with its
index, most frequent first, ties in order of the values, as the indexer numbers them. The counts are dealt by ranges of that
order, each part numbers its own rows, and the totals of the parts before are added; only those totals, a row per part, are gathered.
Dictionaries are kept as Parquet and joined by their counted size: broadcast while they are small, else by shuffle with frequent
values spread over tasks.

A NULL is no value; it and values that were not learned get the index behind the last one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ontarmac.operators import joins
from ontarmac.session import cut

VALUES_PER_PART = 1 << 20
_ROW_BITS = 33  # of monotonically_increasing_id; those above number the partition


@dataclass(frozen=True)
class Dictionary:
    """The values of a column: ``table`` has ``value``, ``index`` and how many ``rows`` had it; ``size`` values, ``rows`` in all."""

    column: str
    table: DataFrame
    size: int
    rows: int

    def save(self, path: str, overwrite: bool = False) -> None:
        mode = "overwrite" if overwrite else "errorifexists"
        self.table.write.mode(mode).parquet(f"{path}/values")
        about = self.table.sparkSession.createDataFrame([(self.column, self.size, self.rows)], "column string, size long, rows long")
        about.write.mode(mode).json(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Dictionary:
        column, size, rows = spark.read.schema("column string, size long, rows long").json(f"{path}/about").first()
        return cls(column, spark.read.parquet(f"{path}/values"), size, rows)

    def index(
        self, df: DataFrame, output: str | None = None, salt_by: list[str] | None = None, max_broadcast_rows: int = joins.MAX_BROADCAST_ROWS
    ) -> DataFrame:
        """``df`` with the index of its values. ``salt_by`` names columns by which rows of a frequent value are told apart."""
        output = output or f"{self.column}_idx"
        lookup = self.table.select(F.col("value").alias(self.column), F.col("index").alias(output), "rows")
        others = salt_by or [c for c in df.columns if c != self.column][:3] or [self.column]
        joined = joins.lookup_join(df, lookup, self.column, "rows", self.size, self.rows, others, max_broadcast_rows)
        return joined.withColumn(output, F.coalesce(output, F.lit(self.size)))


def learn(df: DataFrame, column: str, values_per_part: int = VALUES_PER_PART) -> Dictionary:
    """Number the values of a column."""
    counts = cut(df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("rows")))
    total = counts.agg(F.count("*").alias("size"), F.sum("rows").alias("rows")).first()
    order = [F.desc("rows"), F.asc("value")]
    parts = -(-total["size"] // values_per_part) or 1
    # written, so that the rows of a part keep their numbers whatever is lost later
    numbered = cut(
        counts.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .select("value", "rows", F.shiftright("place", _ROW_BITS).alias("part"), F.col("place").bitwiseAND((1 << _ROW_BITS) - 1).alias("place"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    totals = numbered.groupBy("part").agg(F.count("*").alias("n"))
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    table = numbered.join(F.broadcast(starts), "part").select("value", (F.col("start") + F.col("place")).cast("long").alias("index"), "rows")
    return Dictionary(column, cut(table), total["size"], total["rows"] or 0)


def learn_all(df: DataFrame, columns: list[str], **settings) -> dict[str, Dictionary]:
    return {column: learn(df, column, **settings) for column in columns}


def index_all(df: DataFrame, dictionaries: dict[str, Dictionary], **settings) -> DataFrame:
    """``df`` with an index column per dictionary."""
    for dictionary in dictionaries.values():
        df = dictionary.index(df, **settings)
    return df
