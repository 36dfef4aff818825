"""Delay history that a flight's own label, or a later one, has no part in.

The plain history (:mod:`history`) takes the rates of the training split as they are, so a training flight's label is in its own
rate. Two other histories with the same columns:

* Leave one out: a training flight's rates are those of the other training flights. Flights of other splits get the plain rates.
* As of the day: each flight's rates are those of the training flights of earlier days.

Both follow from integer counts. Leaving one out subtracts the flight's own count from its key's. As of a day, counts per key
and day are cumulated: within a key's month over its days, and over the totals of the months before. So no task sees more of a
key than a month's days or its months, however many flights it has. Each flight finds its key's row of its day by an equality
join, as every day with a flight has one.

A key without such flights gets the overall rate, left out or cumulated the same way; before the first day there is none, and
the rate is NULL. Flights without a key or a day get the overall rate of their day, or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ontarmac import constants as K
from ontarmac.operators import features, history, joins
from ontarmac.session import cut

#: What tells flights of one key apart when a hot key is spread over tasks.
SPREAD_BY = ["flight_date", "carrier", "sched_dep_minutes"]
KEYS = {"origin": K.HISTORY_COLUMNS[0], "route": K.HISTORY_COLUMNS[1]}
KINDS = ["train", "leave_one_out", "as_of"]


def _is_train() -> Column:
    return F.col("split") == "train"


def _rate(late: Column, labelled: Column) -> Column:
    return F.when(labelled > 0, late / labelled)


# --- leave one out ---------------------------------------------------------------------------------


def leave_one_out(
    df: DataFrame, label: str = K.LABEL, max_broadcast_rows: int = joins.MAX_BROADCAST_ROWS, salt_by: list[str] = SPREAD_BY
) -> DataFrame:
    """Add both rates, each training flight's without itself."""
    counts = cut(history.late_counts(df, list(KEYS), label))
    totals = counts.agg(
        *[F.sum(c).alias(c) for c in ("late", "labelled", "trained", "flights")], *[F.count_distinct(k).alias(k) for k in KEYS]
    ).first()
    if not totals["trained"]:
        raise ValueError("the training split is empty, so there is no delay history to learn")
    own = F.when(_is_train(), F.col(label))
    own_late, own_labelled = F.coalesce(own, F.lit(0)), own.isNotNull().cast("int")
    joined = df
    for key in KEYS:
        per_key = counts.groupBy(key).agg(
            F.sum("late").alias(f"_late_{key}"), F.sum("labelled").alias(f"_labelled_{key}"), F.sum("flights").alias("flights")
        )
        # one row more than there are values, for flights without one
        joined = joins.lookup_join(joined, per_key, key, "flights", totals[key] + 1, totals["flights"], salt_by, max_broadcast_rows)
    overall = _rate(F.lit(totals["late"]) - own_late, F.lit(totals["labelled"]) - own_labelled)
    rates = {
        name: F.coalesce(_rate(F.col(f"_late_{key}") - own_late, F.col(f"_labelled_{key}") - own_labelled), overall)
        for key, name in KEYS.items()
    }
    return joined.withColumns(rates).drop(*[f"_{c}_{key}" for key in KEYS for c in ("late", "labelled")])


# --- as of a day -----------------------------------------------------------------------------------


def daily_counts(df: DataFrame, key: str, day: str = "flight_date", label: str = K.LABEL) -> DataFrame:
    """Per key and day with a flight of any split: late and labelled training flights, and all flights."""
    trained = F.when(_is_train(), F.col(label))
    return (
        df.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, F.col(day).alias("day"))
        .agg(F.sum(trained).alias("late"), F.count(trained).alias("labelled"), F.count("*").alias("flights"))
        .fillna(0, ["late"])
    )


def before_day(daily: DataFrame, key: str) -> DataFrame:
    """The counts of all earlier days for each key and day, from written daily counts."""
    by_month = daily.withColumn("month", F.trunc("day", "month"))
    sums = ["late", "labelled"]
    earlier_days = Window.partitionBy(key, "month").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    earlier_months = Window.partitionBy(key).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = by_month.groupBy(key, "month").agg(*[F.sum(c).alias(c) for c in sums])
    months = months.select(key, "month", *[F.coalesce(F.sum(c).over(earlier_months), F.lit(0)).alias(f"{c}_months") for c in sums])
    within = by_month.withColumns({f"{c}_days": F.coalesce(F.sum(c).over(earlier_days), F.lit(0)) for c in sums})
    return within.join(months, [key, "month"]).select(
        key, "day", *[(F.col(f"{c}_days") + F.col(f"{c}_months")).alias(c) for c in sums], "flights"
    )


def as_of_day(
    df: DataFrame,
    day: str = "flight_date",
    label: str = K.LABEL,
    max_broadcast_rows: int = joins.MAX_BROADCAST_ROWS,
    salt_by: list[str] = SPREAD_BY,
) -> DataFrame:
    """Add both rates, each flight's as of its day."""
    joined = df
    for key, name in KEYS.items():
        daily = cut(daily_counts(df, key, day, label))
        known = before_day(daily, key).select(
            F.struct(key, "day").alias(f"_{key}_day"), _rate(F.col("late"), F.col("labelled")).alias(name), "flights"
        )
        size = daily.agg(F.count("*").alias("rows"), F.sum("flights").alias("flights")).first()
        at = F.when(F.col(key).isNotNull() & F.col(day).isNotNull(), F.struct(F.col(key).alias(key), F.col(day).alias("day")))
        joined = joins.lookup_join(
            joined.withColumn(f"_{key}_day", at), known, f"_{key}_day", "flights", size["rows"], size["flights"] or 0, salt_by, max_broadcast_rows
        ).drop(f"_{key}_day")
    # a row per day that has flights: a calendar's worth, whatever the number of flights
    days = cut(daily_counts(df.withColumn("_all", F.lit(1)), "_all", day, label))
    overall = before_day(days, "_all").select(F.col("day").alias("_day"), _rate(F.col("late"), F.col("labelled")).alias("_overall"))
    return (
        joined.join(F.broadcast(overall), F.col(day) == F.col("_day"), "left")
        .withColumns({name: F.coalesce(name, "_overall") for name in KEYS.values()})
        .drop("_day", "_overall")
    )


# --- feature tables --------------------------------------------------------------------------------


def history_feature_table(
    flights: DataFrame,
    kind: str,
    train_until: int = K.TRAIN_UNTIL,
    valid_until: int = K.VALID_UNTIL,
    max_broadcast_rows: int = joins.MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The 35-column feature table with the history of a kind: ``train`` (the plain one), ``leave_one_out`` or ``as_of``."""
    if kind not in KINDS:
        raise ValueError(f"unknown history: {kind}; choose from {', '.join(KINDS)}")
    if kind == "train":
        return history.history_feature_table(flights, train_until, valid_until, max_broadcast_rows)
    narrow = features.feature_projection(features.derive(flights, train_until, valid_until))
    add = leave_one_out if kind == "leave_one_out" else as_of_day
    return history.ordered(add(narrow, max_broadcast_rows=max_broadcast_rows))
