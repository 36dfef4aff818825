"""Clock times written as HHMM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ontarmac.functions.casts import as_column, number

MINUTES_PER_DAY = 1440


def hhmm_to_minutes(column: str | Column) -> Column:
    """Minutes after midnight. 2400 gives 1440; past four digits only the first four count."""
    value = F.substring(number(column).cast("string"), 1, 4).try_cast("int")
    # HH*100 + MM less 40 for each hour is HH*60 + MM
    return (value - F.floor(value / 100) * 40).cast("int")


def hour_of(minutes: str | Column) -> Column:
    return F.floor(as_column(minutes) / 60).cast("int")


def part_of_day(hour: str | Column) -> Column:
    """Named part of the day; an unknown hour counts as evening."""
    h = as_column(hour)
    return (
        F.when(h < 6, "overnight").when(h < 12, "morning").when(h < 18, "afternoon").otherwise("evening")
    )


def elapsed_minutes(departure: str | Column, arrival: str | Column) -> Column:
    """Scheduled minutes between two local HHMM times; not later means the next day."""
    gap = hhmm_to_minutes(arrival) - hhmm_to_minutes(departure)
    return F.when(gap <= 0, gap + MINUTES_PER_DAY).otherwise(gap)


def is_clock_time(column: str | Column) -> Column:
    """Whether an integer is a time from 0000 to 2359."""
    value = as_column(column)
    return value.between(0, 2359) & (value % 100 <= 59)
