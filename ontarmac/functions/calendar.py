"""Calendar features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ontarmac.functions.casts import as_column


def season(month: str | Column) -> Column:
    """Meteorological season; anything that is no month from 12 to 8 counts as fall."""
    m = as_column(month)
    return (
        F.when(m.isin(12, 1, 2), "winter")
        .when(m.isin(3, 4, 5), "spring")
        .when(m.isin(6, 7, 8), "summer")
        .otherwise("fall")
    )


def quarter_of(month: str | Column) -> Column:
    return (F.floor((as_column(month) - 1) / 3) + 1).cast("int")


def is_weekend(day_of_week: str | Column) -> Column:
    """1 on Saturday and Sunday, with Monday = 1."""
    return as_column(day_of_week).isin(6, 7).cast("int")


def date_of(year: str | Column, month: str | Column, day_of_month: str | Column) -> Column:
    """The date of three integers, NULL where there is no such day."""
    parts = [as_column(c).cast("string") for c in (year, month, day_of_month)]
    return F.concat_ws("-", F.lpad(parts[0], 4, "0"), *[F.lpad(p, 2, "0") for p in parts[1:]]).try_cast("date")
