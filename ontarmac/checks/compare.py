"""Compare a Spark result with the SQL counterpart run by DuckDB on the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def sql_session(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(result: pa.Table) -> list[tuple]:
    names = sorted(result.column_names)
    columns = [result.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def _types(result: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in result.schema}


def difference(spark_result: DataFrame, sql_result: pa.Table) -> str | None:
    """None when names, types and the multiset of rows agree, else what differs."""
    ours = spark_result.toArrow()
    if _types(ours) != _types(sql_result):
        both = sorted(set(_types(ours).items()) ^ set(_types(sql_result).items()))
        return f"types differ: {both}"
    if ours.num_rows != sql_result.num_rows:
        return f"{ours.num_rows} rows, expected {sql_result.num_rows}"
    for mine, theirs in zip(_rows(ours), _rows(sql_result)):
        if mine != theirs:
            return f"row {mine}\nexpected {theirs}"
    return None
