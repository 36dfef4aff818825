"""The feature table: valid flights with calendar, schedule, route, label and split columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ontarmac import constants as K
from ontarmac.functions import calendar, clock, text
from ontarmac.functions.casts import comparable, day, number, require_columns

# fixed values: feature columns and the curated columns they are read from
INT_COLUMNS = {
    "quarter": "Quarter",
    "month": "Month",
    "day_of_month": "DayofMonth",
    "day_of_week": "DayOfWeek",
    "origin_wac": "OriginWac",
    "dest_wac": "DestWac",
    "distance_group": "DistanceGroup",
    "dot_id_reporting_airline": "DOT_ID_Reporting_Airline",
    "origin_airport_id": "OriginAirportID",
    "dest_airport_id": "DestAirportID",
}
DOUBLE_COLUMNS = {"scheduled_elapsed_time": "CRSElapsedTime", "distance": "Distance"}
TEXT_COLUMNS = {
    "carrier": "Reporting_Airline",
    "origin": "Origin",
    "origin_state": "OriginState",
    "dest": "Dest",
    "dest_state": "DestState",
}
# fixed values: the feature table in order
FEATURE_COLUMNS = [
    "year",
    "quarter",
    "month",
    "day_of_month",
    "day_of_week",
    "flight_date",
    "day_of_year",
    "week_of_year",
    "is_weekend",
    "season",
    "sched_dep_minutes",
    "sched_arr_minutes",
    "sched_dep_hour",
    "sched_arr_hour",
    "dep_time_bucket",
    "carrier",
    "origin",
    "origin_state",
    "origin_wac",
    "dest",
    "dest_state",
    "dest_wac",
    "route",
    "carrier_route",
    "scheduled_elapsed_time",
    "distance",
    "distance_group",
    "dot_id_reporting_airline",
    "origin_airport_id",
    "dest_airport_id",
    "label_delay_15",
    "arrival_delay_minutes",
    "split",
]


def valid_flights(flights: DataFrame) -> DataFrame:
    """Flights that were flown as scheduled and have every value a model or label needs."""
    require_columns(flights, ["Cancelled", "Diverted", *K.REQUIRED_VALUES])
    present = [F.col(c).isNotNull() for c in K.REQUIRED_VALUES]
    flown = [number(c, "double") == 0 for c in ("Cancelled", "Diverted")]
    return flights.filter(reduce(lambda a, b: a & b, present + flown))


def with_schedule(flights: DataFrame) -> DataFrame:
    return (
        flights.withColumns(
            {
                "sched_dep_minutes": clock.hhmm_to_minutes("CRSDepTime"),
                "sched_arr_minutes": clock.hhmm_to_minutes("CRSArrTime"),
            }
        )
        .withColumns(
            {
                "sched_dep_hour": clock.hour_of("sched_dep_minutes"),
                "sched_arr_hour": clock.hour_of("sched_arr_minutes"),
            }
        )
        .withColumn("dep_time_bucket", clock.part_of_day("sched_dep_hour"))
    )


def with_calendar(flights: DataFrame) -> DataFrame:
    return flights.withColumn("flight_date", day("FlightDate")).withColumns(
        {
            "day_of_year": F.dayofyear("flight_date"),
            "week_of_year": F.weekofyear("flight_date"),
            "is_weekend": calendar.is_weekend(number("DayOfWeek")),
            "season": calendar.season(comparable(flights, "Month")),
        }
    )


def with_route(flights: DataFrame) -> DataFrame:
    return flights.withColumns(
        {
            "route": text.joined_code("Origin", "Dest"),
            "carrier_route": text.joined_code("Reporting_Airline", "Origin", "Dest"),
        }
    )


def with_label_and_split(
    flights: DataFrame, train_until: int = K.TRAIN_UNTIL, valid_until: int = K.VALID_UNTIL
) -> DataFrame:
    """Label, delay minutes, and the part of the data a flight's year puts it in."""
    year = comparable(flights, "Year")
    return flights.withColumns(
        {
            "label_delay_15": number("ArrDel15"),
            "arrival_delay_minutes": number("ArrDelay", "double"),
            "split": F.when(year <= train_until, "train").when(year <= valid_until, "valid").otherwise("test"),
        }
    )


def feature_projection(derived: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The typed 33 columns; ``extra`` double columns go before the schedule measures."""
    require_columns(derived, ["Year", *INT_COLUMNS.values(), *DOUBLE_COLUMNS.values(), *TEXT_COLUMNS.values()])
    source = (
        {"year": comparable(derived, "Year").cast("int")}
        | {name: comparable(derived, c).cast("int") for name, c in INT_COLUMNS.items()}
        | {name: number(c, "double") for name, c in DOUBLE_COLUMNS.items()}
        | {name: F.col(c) for name, c in TEXT_COLUMNS.items()}
    )
    columns = [source.get(name, F.col(name)).alias(name) for name in FEATURE_COLUMNS]
    if extra:
        at = FEATURE_COLUMNS.index("scheduled_elapsed_time")
        columns[at:at] = [F.col(c).cast("double").alias(c) for c in extra]
    return derived.select(*columns)


def derive(flights: DataFrame, train_until: int = K.TRAIN_UNTIL, valid_until: int = K.VALID_UNTIL) -> DataFrame:
    """Valid flights with every derived column, before the projection."""
    return (
        flights.transform(valid_flights)
        .transform(with_schedule)
        .transform(with_calendar)
        .transform(with_route)
        .transform(with_label_and_split, train_until, valid_until)
    )


def feature_table(flights: DataFrame, train_until: int = K.TRAIN_UNTIL, valid_until: int = K.VALID_UNTIL) -> DataFrame:
    return derive(flights, train_until, valid_until).transform(feature_projection)


def year_window(df: DataFrame, first: int | None = None, last: int | None = None, column: str = "year") -> DataFrame:
    year = comparable(df, column)
    if first is not None:
        df = df.filter(year >= first)
    if last is not None:
        df = df.filter(year <= last)
    return df


def years_in(df: DataFrame, years: list[int], column: str = "Year") -> DataFrame:
    return df.filter(comparable(df, column).isin(*years))


def of_split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)
