"""Flights, features and historical rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac.checks import tables as T
from ontarmac.operators import features as X, history as H, summaries as S, unleaked as U
from ontarmac.sources import curated

_FEATURES = {"train_until": T.TRAIN_UNTIL, "valid_until": T.VALID_UNTIL}


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return X.feature_table(T.landed_flights(spark, folder), **_FEATURES)


def history_table(spark: SparkSession, folder: str) -> DataFrame:
    return H.history_feature_table(T.landed_flights(spark, folder), **_FEATURES)


def shuffled_history(spark: SparkSession, folder: str) -> DataFrame:
    """The history table by way of the join that large rate tables take."""
    return H.history_feature_table(T.landed_flights(spark, folder), **_FEATURES, max_broadcast_rows=0)


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the delay history is learned from; none would be an error."""
    rates = H.learn_rates(X.derive(T.landed_flights(spark, folder), **_FEATURES))
    return rates.routes.agg(F.sum("flights").alias("flights"), F.lit(rates.overall).alias("overall"))


def late_routes(spark: SparkSession, folder: str) -> DataFrame:
    return S.late_routes(history_table(spark, folder))


KEY = ["FlightDate", "Reporting_Airline", "Origin", "Dest", "CRSDepTime"]

QUERIES = {
    "flights_view": T.flights,
    "valid_flights": lambda s, d: X.valid_flights(T.flights(s, d)),
    "feature_time": lambda s, d: X.with_schedule(X.valid_flights(T.landed_flights(s, d))).select(
        *KEY, "CRSArrTime", "sched_dep_minutes", "sched_arr_minutes", "sched_dep_hour", "sched_arr_hour",
        "dep_time_bucket",
    ),
    "feature_calendar": lambda s, d: X.with_calendar(T.landed_flights(s, d)).select(
        *KEY, "flight_date", "day_of_year", "week_of_year", "is_weekend", "season"
    ),
    "feature_route": lambda s, d: X.with_route(T.landed_flights(s, d)).select(*KEY, "route", "carrier_route"),
    "feature_label_split": lambda s, d: X.with_label_and_split(T.landed_flights(s, d), **_FEATURES).select(
        *KEY, "label_delay_15", "arrival_delay_minutes", "split"
    ),
    "feature_table": feature_table,
    "feature_rows": lambda s, d: S.row_count(feature_table(s, d)),
    "flights_preview": lambda s, d: curated.preview(T.landed_flights(s, d)),
    "split_counts": lambda s, d: S.split_counts(feature_table(s, d)),
    "label_distribution": lambda s, d: S.label_distribution(X.of_split(feature_table(s, d), "train")),
    "year_window": lambda s, d: X.year_window(feature_table(s, d), 1997, 2000).select(
        "year", "month", "route", "flight_date", "split"
    ),
    "years_in": lambda s, d: X.years_in(T.landed_flights(s, d), [1998, 1999, 2000]).select(*KEY, "year"),
    "split_filter": lambda s, d: X.of_split(feature_table(s, d), "valid").select(
        "split", "year", "carrier_route", "flight_date", "label_delay_15"
    ),
    "global_delay_rate": lambda s, d: H.global_rate(feature_table(s, d)),
    "hist_origin_rate": lambda s, d: H.origin_rates(feature_table(s, d)),
    "hist_route_rate": lambda s, d: H.route_rates(feature_table(s, d)),
    "hist_features": history_table,
    "hist_features_shuffled": shuffled_history,
    "training_rows": training_rows,
    "hist_leave_one_out": lambda s, d: U.history_feature_table(T.landed_flights(s, d), "leave_one_out", T.TRAIN_UNTIL, T.VALID_UNTIL),
    "hist_as_of": lambda s, d: U.history_feature_table(T.landed_flights(s, d), "as_of", T.TRAIN_UNTIL, T.VALID_UNTIL),
    "late_routes": late_routes,
}

_KEY_SQL = ", ".join(f'"{c}"' for c in KEY)
_W = "WITH " + T.FEATURES_SQL
HISTORY_SQL = T.FEATURES_SQL + """,
train AS (SELECT * FROM features WHERE split = 'train'),
overall AS (SELECT sum(label_delay_15)::double / count(label_delay_15) AS rate FROM train),
origin_rate AS (
  SELECT origin, sum(label_delay_15)::double / count(label_delay_15) AS origin_hist_delay_rate FROM train GROUP BY origin),
route_rate AS (
  SELECT route, sum(label_delay_15)::double / count(label_delay_15) AS route_hist_delay_rate FROM train GROUP BY route),
history AS (
  SELECT f.*, coalesce(o.origin_hist_delay_rate, g.rate) AS origin_hist_delay_rate,
    coalesce(r.route_hist_delay_rate, g.rate) AS route_hist_delay_rate
  FROM features f LEFT JOIN origin_rate o ON f.origin = o.origin LEFT JOIN route_rate r ON f.route = r.route
  CROSS JOIN overall g
)"""

def _as_of_sql(key: str) -> str:
    """Cumulated daily counts of earlier days per key."""
    return f"""
daily_{key} AS (SELECT {key}, flight_date, sum(CASE WHEN split = 'train' THEN label_delay_15 ELSE 0 END) AS late,
    sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS n FROM known GROUP BY {key}, flight_date),
as_of_{key} AS (SELECT {key}, flight_date, sum(late) OVER w AS late, sum(n) OVER w AS n FROM daily_{key}
  WINDOW w AS (PARTITION BY {key} ORDER BY flight_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


_AS_OF_SQL = T.FEATURES_SQL + ", known AS (SELECT *, 1 AS everything FROM features)," + ",".join(
    _as_of_sql(key) for key in ("origin", "route", "everything")
) + """,
history AS (SELECT f.* EXCLUDE (everything),
    coalesce(CASE WHEN o.n > 0 THEN o.late::double / o.n END, CASE WHEN g.n > 0 THEN g.late::double / g.n END) AS origin_hist_delay_rate,
    coalesce(CASE WHEN r.n > 0 THEN r.late::double / r.n END, CASE WHEN g.n > 0 THEN g.late::double / g.n END) AS route_hist_delay_rate
  FROM known f JOIN as_of_origin o ON f.origin = o.origin AND f.flight_date = o.flight_date
  JOIN as_of_route r ON f.route = r.route AND f.flight_date = r.flight_date
  JOIN as_of_everything g ON f.flight_date = g.flight_date)"""

_LEFT_OUT_SQL = T.FEATURES_SQL + """,
marked AS (SELECT *, CASE WHEN split = 'train' THEN label_delay_15 ELSE 0 END AS y, CASE WHEN split = 'train' THEN 1 ELSE 0 END AS t FROM features),
sums AS (SELECT *, sum(y) OVER (PARTITION BY origin) - y AS o_late, sum(t) OVER (PARTITION BY origin) - t AS o_n,
    sum(y) OVER (PARTITION BY route) - y AS r_late, sum(t) OVER (PARTITION BY route) - t AS r_n,
    sum(y) OVER () - y AS g_late, sum(t) OVER () - t AS g_n FROM marked),
history AS (SELECT * EXCLUDE (y, t, o_late, o_n, r_late, r_n, g_late, g_n),
    CASE WHEN o_n > 0 THEN o_late::double / o_n ELSE g_late::double / g_n END AS origin_hist_delay_rate,
    CASE WHEN r_n > 0 THEN r_late::double / r_n ELSE g_late::double / g_n END AS route_hist_delay_rate FROM sums)"""

ORACLES = {
    "hist_leave_one_out": f"WITH {_LEFT_OUT_SQL} SELECT * FROM history",
    "hist_as_of": f"WITH {_AS_OF_SQL} SELECT * FROM history",
    "flights_view": f"WITH {T.FLIGHTS_SQL} SELECT * FROM flights",
    "valid_flights": f"WITH {T.VALID_SQL} SELECT * FROM valid",
    "feature_time": f"""WITH {T.VALID_SQL}, timed AS (SELECT *,
      cast(substr("CRSDepTime", 1, 2) AS int) * 60 + cast(substr("CRSDepTime", 3, 2) AS int) AS sched_dep_minutes,
      cast(substr("CRSArrTime", 1, 2) AS int) * 60 + cast(substr("CRSArrTime", 3, 2) AS int) AS sched_arr_minutes
      FROM valid) SELECT {_KEY_SQL}, "CRSArrTime", sched_dep_minutes, sched_arr_minutes,
      sched_dep_minutes // 60 AS sched_dep_hour, sched_arr_minutes // 60 AS sched_arr_hour,
      CASE WHEN sched_dep_minutes < 360 THEN 'overnight' WHEN sched_dep_minutes < 720 THEN 'morning'
      WHEN sched_dep_minutes < 1080 THEN 'afternoon' ELSE 'evening' END AS dep_time_bucket FROM timed""",
    "feature_calendar": f"""WITH {T.FLIGHTS_SQL} SELECT {_KEY_SQL}, cast("FlightDate" AS date) AS flight_date,
      cast(dayofyear(cast("FlightDate" AS date)) AS integer) AS day_of_year,
      cast(weekofyear(cast("FlightDate" AS date)) AS integer) AS week_of_year,
      CASE WHEN "DayOfWeek" IN ('6', '7') THEN 1 ELSE 0 END AS is_weekend,
      CASE WHEN "Month" IN ('12', '1', '2') THEN 'winter' WHEN "Month" IN ('3', '4', '5') THEN 'spring'
      WHEN "Month" IN ('6', '7', '8') THEN 'summer' ELSE 'fall' END AS season FROM flights""",
    "feature_route": f"""WITH {T.FLIGHTS_SQL} SELECT {_KEY_SQL}, "Origin" || '_' || "Dest" AS route,
      "Reporting_Airline" || '_' || "Origin" || '_' || "Dest" AS carrier_route FROM flights""",
    "feature_label_split": f"""WITH {T.FLIGHTS_SQL} SELECT {_KEY_SQL}, {T.sql_int('"ArrDel15"')} AS label_delay_15,
      cast("ArrDelay" AS double) AS arrival_delay_minutes, CASE WHEN cast("Year" AS int) <= {T.TRAIN_UNTIL} THEN 'train'
      WHEN cast("Year" AS int) = {T.VALID_UNTIL} THEN 'valid' ELSE 'test' END AS split FROM flights""",
    "feature_table": f"{_W} SELECT * FROM features",
    "feature_rows": f"{_W} SELECT count(*) AS rows FROM features",
    "split_counts": f"{_W} SELECT split, count(*) AS count FROM features GROUP BY split ORDER BY split",
    "label_distribution": f"""{_W} SELECT label_delay_15, count(*) AS count FROM features WHERE split = 'train'
      GROUP BY label_delay_15 ORDER BY label_delay_15""",
    "year_window": f"""{_W} SELECT year, month, route, flight_date, split FROM features
      WHERE year >= 1997 AND year <= 2000""",
    "years_in": f"""WITH {T.FLIGHTS_SQL} SELECT {_KEY_SQL}, cast("Year" AS integer) AS year FROM flights
      WHERE "Year" IN ('1998', '1999', '2000')""",
    "split_filter": f"""{_W} SELECT split, year, carrier_route, flight_date, label_delay_15 FROM features
      WHERE split = 'valid'""",
    "global_delay_rate": f"""{_W} SELECT sum(label_delay_15)::double / count(label_delay_15) AS global_delay_rate
      FROM features WHERE split = 'train'""",
    "hist_origin_rate": f"WITH {HISTORY_SQL} SELECT * FROM origin_rate",
    "hist_route_rate": f"WITH {HISTORY_SQL} SELECT * FROM route_rate",
    "hist_features": f"WITH {HISTORY_SQL} SELECT * FROM history",
    "hist_features_shuffled": f"WITH {HISTORY_SQL} SELECT * FROM history",
    "training_rows": f"""WITH {HISTORY_SQL} SELECT cast(count(*) AS bigint) AS flights, any_value(rate) AS overall
      FROM features CROSS JOIN overall""",
    "flights_preview": f"""WITH {T.FLIGHTS_SQL} SELECT cast("Year" AS integer) AS "Year", cast("Month" AS integer) AS "Month",
      "Origin", "Dest", "ArrDelay" FROM flights ORDER BY 1, 2, 3, 4, 5 NULLS LAST LIMIT 5""",
    "late_routes": f"""WITH {HISTORY_SQL} SELECT route, max(route_hist_delay_rate) AS route_hist_delay_rate,
      count(*) AS flights FROM history GROUP BY route ORDER BY route_hist_delay_rate DESC, route LIMIT 20""",
}
