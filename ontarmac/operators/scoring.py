"""Scoring requests: checks, model inputs, predictions and explanations, for whole tables of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ontarmac import constants as K
from ontarmac.functions import calendar, clock, geo, text
from ontarmac.operators.evaluation import class_score
from ontarmac.sources.airports import airports

REQUEST_SCHEMA = StructType(
    [StructField("request_id", StringType()), StructField("model_id", StringType())]
    + [StructField(c, IntegerType()) for c in ("year", "month", "day_of_month", "day_of_week")]
    + [StructField(c, StringType()) for c in ("carrier", "origin", "dest")]
    + [StructField(c, IntegerType()) for c in ("crs_dep_time", "crs_arr_time")]
)
REQUEST_FIELDS = [f.name for f in REQUEST_SCHEMA.fields[2:]]

_DOUBLES = {"scheduled_elapsed_time", "distance"}
MODEL_INPUT_SCHEMA = StructType(
    [StructField(c, DoubleType() if c in _DOUBLES else IntegerType(), False) for c in K.NUMERIC_COLUMNS]
    + [StructField(c, StringType(), False) for c in K.CATEGORICAL_COLUMNS]
)
MODEL_INPUTS = MODEL_INPUT_SCHEMA.names

ROUTE_COLUMNS = ["origin_city", "origin_wac", "dest_city", "dest_wac", "distance_miles"]


def field_faults() -> list[Column]:
    """One text per faulty field, NULL where the field is sound."""

    def fault(bad: Column, message: str) -> Column:
        return F.when(bad, message)

    limits = {"year": (1987, 2100), "month": (1, 12), "day_of_month": (1, 31), "day_of_week": (1, 7)}
    missing = [fault(F.col(c).isNull(), f"{c} is missing") for c in REQUEST_FIELDS]
    ranges = [
        fault(~F.col(c).between(low, high), f"{c} must be from {low} to {high}") for c, (low, high) in limits.items()
    ]
    lengths = [fault(~F.length("carrier").between(2, 10), "carrier must have 2 to 10 characters")] + [
        fault(F.length(c) != 3, f"{c} must have 3 characters") for c in ("origin", "dest")
    ]
    times = [
        fault(~clock.is_clock_time(c), f"{c} must be a time in HHMM format") for c in ("crs_dep_time", "crs_arr_time")
    ]
    return [*missing, *ranges, *lengths, *times]


def with_faults(requests: DataFrame) -> DataFrame:
    """Normalised requests with ``faults``: every reason why one cannot be scored.

    Lengths are checked on the codes as sent. The weekday is not checked against the date.
    """
    codes = {c: text.code(c) for c in ("carrier", "origin", "dest")}
    checked = requests.withColumn("_fields", F.array_compact(F.array(*field_faults())))
    normal = checked.withColumns(codes | {"model_id": text.model_key("model_id")})
    located = with_route_info(normal)
    sound = F.size("_fields") == 0
    date = calendar.date_of("year", "month", "day_of_month")
    lookups = [
        F.when(sound & date.isNull(), "no such date"),
        F.when(sound & F.col("origin_city").isNull(), F.concat(F.lit("Unsupported airport code: "), "origin")),
        F.when(sound & F.col("dest_city").isNull(), F.concat(F.lit("Unsupported airport code: "), "dest")),
        F.when(
            sound & (F.col("origin") == F.col("dest")) & F.col("origin_city").isNotNull(),
            "Origin and destination must be different.",
        ),
    ]
    return located.withColumn("faults", F.concat("_fields", F.array_compact(F.array(*lookups)))).drop("_fields")


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("faults") == 0).drop("faults")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("faults") > 0).drop(*ROUTE_COLUMNS)


def with_route_info(df: DataFrame) -> DataFrame:
    """City and area code of both ends and the distance between them, NULL for unknown airports."""
    known = airports(df.sparkSession)
    joined = df
    for end in ("origin", "dest"):
        side = known.select(*[F.col(c).alias(f"{end}_{c}") for c in known.columns])
        joined = joined.join(F.broadcast(side), F.upper(end) == F.col(f"{end}_code"), "left")
    miles = geo.great_circle_miles(*[F.col(c) for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")])
    return joined.withColumn("distance_miles", miles).select(*df.columns, *ROUTE_COLUMNS)


def route_info(pairs: DataFrame) -> DataFrame:
    """Route facts for pairs of different, known airports."""
    known = with_route_info(pairs.withColumns({c: text.code(c) for c in ("origin", "dest")}))
    return known.filter(
        F.col("origin_city").isNotNull() & F.col("dest_city").isNotNull() & (F.col("origin") != F.col("dest"))
    )


def model_inputs(requests: DataFrame) -> DataFrame:
    """The 22 model inputs of accepted requests, added to their other columns."""
    dep_minutes = clock.hhmm_to_minutes("crs_dep_time")
    date = calendar.date_of("year", "month", "day_of_month")
    dep_hour = clock.hour_of("sched_dep_minutes")
    return (
        requests.withColumns({"sched_dep_minutes": dep_minutes, "sched_arr_minutes": clock.hhmm_to_minutes("crs_arr_time")})
        .withColumns(
            {
                "quarter": calendar.quarter_of("month"),
                "day_of_year": F.dayofyear(date),
                "week_of_year": F.weekofyear(date),
                "is_weekend": calendar.is_weekend("day_of_week"),
                "sched_dep_hour": dep_hour,
                "sched_arr_hour": clock.hour_of("sched_arr_minutes"),
                "scheduled_elapsed_time": clock.elapsed_minutes("crs_dep_time", "crs_arr_time").cast("double"),
                "distance": F.col("distance_miles"),
                "distance_group": geo.distance_group("distance_miles"),
                "season": calendar.season("month"),
                "dep_time_bucket": clock.part_of_day(dep_hour),
            }
        )
        .select(*[c for c in requests.columns if c not in MODEL_INPUTS], *MODEL_INPUTS)
    )


def routed(checked: DataFrame, models: list[str], default: str) -> DataFrame:
    """Checked requests with the model each gets; asking for one that is not deployed is a fault of a sound request."""
    if default not in models:
        raise ValueError(f"unknown default model: {default}")
    named = checked.withColumn("model_id", F.coalesce(text.model_key("model_id"), F.lit(default)))
    unknown = (F.size("faults") == 0) & ~F.col("model_id").isin(*models)
    fault = F.array(F.concat(F.lit("Unsupported model_id: "), "model_id"))
    return named.withColumn("faults", F.when(unknown, fault).otherwise(F.col("faults")))


def predict(inputs: DataFrame, model: PipelineModel) -> DataFrame:
    """Probability and predicted class of each row under one model."""
    return model.transform(inputs).select(
        *inputs.columns,
        class_score("probability").alias("probability_delay_15"),
        F.col("prediction").cast("int").alias("prediction_delay_15"),
    )


def reasons() -> Column:
    """Why a flight may be late, in fixed order; a default text stands alone."""
    found = F.array_compact(
        F.array(
            F.when(F.col("dep_time_bucket").isin("evening", "overnight"), K.REASON_LATE_IN_DAY),
            F.when(F.col("distance") >= K.LONG_HAUL_MILES, K.REASON_LONG_HAUL),
            F.when(F.col("season").isin("summer", "winter"), K.REASON_SEASON),
            F.when(F.col("is_weekend") == 1, K.REASON_WEEKEND),
        )
    )
    return F.when(F.size(found) == 0, F.array(F.lit(K.REASON_NONE))).otherwise(found)


def explain(scored: DataFrame, probability: str = "probability_delay_15") -> DataFrame:
    """Add risk band, sentence and reasons to scored flights."""
    return scored.withColumn("risk_band", text.risk_band(probability)).withColumns(
        {"summary": text.explain_sentence(probability, "risk_band"), "reasons": reasons()}
    )


PREVIEW_ORDER = ["carrier", "origin", "dest", K.LABEL, "split"]


def preview_rows(rows: DataFrame, limit: int = 10) -> DataFrame:
    """The rows to preview, chosen before they are scored."""
    return rows.orderBy(*PREVIEW_ORDER).limit(limit)


def preview(predictions: DataFrame, limit: int = 10) -> DataFrame:
    """A few predictions to look at, in a fixed order."""
    shown = predictions.select(
        K.LABEL,
        "prediction",
        class_score("probability").alias("probability_delay_15"),
        "carrier",
        "origin",
        "dest",
        "split",
    )
    return shown.orderBy(*PREVIEW_ORDER, F.desc("probability_delay_15")).limit(limit)
