"""Typed reads of all-string columns that hold under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType


def as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def number(column: str | Column, to: str = "int") -> Column:
    """Read ``"1.00"`` as 1; text that is no number gives NULL instead of an error."""
    value = as_column(column).try_cast("double")
    return value if to == "double" else value.try_cast(to)


def day(column: str | Column) -> Column:
    """Read an ISO date; an impossible date gives NULL."""
    return as_column(column).try_cast("date")


def comparable(df: DataFrame, name: str) -> Column:
    """The column itself when it is numeric, so partition pruning still sees it, else its number."""
    kind = next((f.dataType for f in df.schema.fields if f.name.lower() == name.lower()), None)
    if kind is None:
        raise ValueError(f"column not found: {name}")
    return F.col(name) if isinstance(kind, NumericType) else number(name)


def require_columns(df: DataFrame, names: list[str]) -> None:
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
