"""Scoring requests, routes, explanations and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac import constants as K
from ontarmac.checks import tables as T
from ontarmac.operators import messages as M, scoring as R


def checked(spark: SparkSession, folder: str) -> DataFrame:
    return R.with_faults(T.requests(spark, folder))


def request_features(spark: SparkSession, folder: str) -> DataFrame:
    return R.model_inputs(R.accepted(checked(spark, folder))).select("request_id", *R.MODEL_INPUTS)


def request_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = R.rejected(checked(spark, folder))
    return rejects.select("request_id", *R.REQUEST_FIELDS, F.array_join("faults", "; ").alias("faults"))


def route_info(spark: SparkSession, folder: str) -> DataFrame:
    return R.route_info(T.requests(spark, folder).select("request_id", "origin", "dest"))


def explained(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted request under a stand-in probability."""
    inputs = R.model_inputs(R.accepted(checked(spark, folder)))
    return R.explain(inputs.withColumn("probability_delay_15", F.expr("(request_id % 10001) / 10000.0D")))


def explain_rows(spark: SparkSession, folder: str) -> DataFrame:
    return explained(spark, folder).select(
        "request_id", "probability_delay_15", "risk_band", "summary", F.array_join("reasons", " ").alias("reasons")
    )


def said(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "conversations").select("conv_id", "turn", "text")


def message_answers(spark: SparkSession, folder: str) -> DataFrame:
    """All messages, about every third of them with a scored flight."""
    flights = explained(spark, folder).select(
        F.col("request_id").alias("flight_id"),
        F.col("origin").alias("flight_origin"),
        F.col("dest").alias("flight_dest"),
        "probability_delay_15",
        "summary",
        "reasons",
    )
    messages = said(spark, folder)
    about = (F.col("flight_id") == F.col("conv_id") + 1) & (F.col("conv_id") % 3 == 0)
    return M.answers(messages.join(flights, about, "left")).select(
        "conv_id", "turn", "tool_name", "assistant_message", "failed"
    )


QUERIES = {
    "request_features": request_features,
    "request_rejects": request_rejects,
    "route_info": route_info,
    "explain_rows": explain_rows,
    "message_intent": lambda s, d: M.with_intent(said(s, d)).select("conv_id", "turn", "tool_name"),
    "message_routes": lambda s, d: M.with_named_route(said(s, d)).select("conv_id", "turn", "origin", "dest"),
    "message_answers": message_answers,
}

LOCATED_SQL = T.REQUESTS_SQL + ", " + T.AIRPORTS_SQL + f""",
placed AS (SELECT r.*, a.city AS origin_city, a.wac AS origin_wac, b.city AS dest_city, b.wac AS dest_wac,
    pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
      + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2) AS h,
    try_cast(lpad(r.year::varchar, 4, '0') || '-' || lpad(r.month::varchar, 2, '0') || '-'
      || lpad(r.day_of_month::varchar, 2, '0') AS date) AS flight_day
  FROM requests r LEFT JOIN airports a ON r.origin = a.code LEFT JOIN airports b ON r.dest = b.code),
located AS (SELECT *, round(3958.8 * 2 * atan2(sqrt(h), sqrt(1 - h)), 1) AS distance_miles FROM placed),
fielded AS (SELECT *, [x FOR x IN [
    CASE WHEN day_of_month IS NULL THEN 'day_of_month is missing' END,
    CASE WHEN carrier IS NULL THEN 'carrier is missing' END,
    CASE WHEN year NOT BETWEEN 1987 AND 2100 THEN 'year must be from 1987 to 2100' END,
    CASE WHEN month NOT BETWEEN 1 AND 12 THEN 'month must be from 1 to 12' END,
    CASE WHEN day_of_month NOT BETWEEN 1 AND 31 THEN 'day_of_month must be from 1 to 31' END,
    CASE WHEN day_of_week NOT BETWEEN 1 AND 7 THEN 'day_of_week must be from 1 to 7' END,
    CASE WHEN length(carrier_sent) NOT BETWEEN 2 AND 10 THEN 'carrier must have 2 to 10 characters' END,
    CASE WHEN length(dest_sent) <> 3 THEN 'dest must have 3 characters' END,
    CASE WHEN crs_dep_time NOT BETWEEN 0 AND 2359 OR crs_dep_time % 100 > 59
      THEN 'crs_dep_time must be a time in HHMM format' END,
    CASE WHEN crs_arr_time NOT BETWEEN 0 AND 2359 OR crs_arr_time % 100 > 59
      THEN 'crs_arr_time must be a time in HHMM format' END] IF x IS NOT NULL] AS fields FROM located),
checked AS (SELECT *, CASE WHEN len(fields) > 0 THEN fields ELSE [x FOR x IN [
    CASE WHEN flight_day IS NULL THEN 'no such date' END,
    CASE WHEN origin_city IS NULL THEN 'Unsupported airport code: ' || origin END,
    CASE WHEN dest_city IS NULL THEN 'Unsupported airport code: ' || dest END,
    CASE WHEN origin = dest AND origin_city IS NOT NULL THEN 'Origin and destination must be different.' END] IF x IS NOT NULL] END AS faults FROM fielded),
clocked AS (SELECT *, (crs_dep_time // 100) * 60 + crs_dep_time % 100 AS dm, (crs_arr_time // 100) * 60 + crs_arr_time % 100 AS am
  FROM checked WHERE len(faults) = 0),
inputs AS (SELECT request_id, year, (month - 1) // 3 + 1 AS quarter, month, day_of_month, day_of_week,
    cast(dayofyear(flight_day) AS integer) AS day_of_year, cast(weekofyear(flight_day) AS integer) AS week_of_year,
    CASE WHEN day_of_week IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, dm AS sched_dep_minutes, am AS sched_arr_minutes,
    dm // 60 AS sched_dep_hour, am // 60 AS sched_arr_hour, origin_wac, dest_wac,
    cast(CASE WHEN am - dm <= 0 THEN am - dm + 1440 ELSE am - dm END AS double) AS scheduled_elapsed_time,
    distance_miles AS distance, cast(greatest(1, ceil(distance_miles / 250)) AS integer) AS distance_group,
    CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring' WHEN month IN (6, 7, 8) THEN 'summer'
      ELSE 'fall' END AS season,
    CASE WHEN dm // 60 < 6 THEN 'overnight' WHEN dm // 60 < 12 THEN 'morning' WHEN dm // 60 < 18 THEN 'afternoon'
      ELSE 'evening' END AS dep_time_bucket, carrier, origin, dest FROM clocked),
explained AS (SELECT *, CASE WHEN p >= 0.65 THEN 'high' WHEN p >= 0.35 THEN 'medium' ELSE 'low' END AS risk_band,
    [x FOR x IN [
      CASE WHEN dep_time_bucket IN ('evening', 'overnight') THEN '{K.REASON_LATE_IN_DAY}' END,
      CASE WHEN distance >= 1500 THEN '{K.REASON_LONG_HAUL}' END,
      CASE WHEN season IN ('summer', 'winter') THEN '{K.REASON_SEASON}' END,
      CASE WHEN is_weekend = 1 THEN '{K.REASON_WEEKEND}' END] IF x IS NOT NULL] AS found
  FROM (SELECT *, (request_id % 10001) / 10000::double AS p FROM inputs)),
told AS (SELECT *, 'Estimated delay>=15m probability is ' || printf('%.1f%%', p * 100) || ', which falls in the '
    || risk_band || ' risk band.' AS summary,
    CASE WHEN len(found) = 0 THEN '{K.REASON_NONE}' ELSE array_to_string(found, ' ') END AS reasons FROM explained)"""

_INTENT_SQL = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + f" THEN '{tool}'"
    for tool, words in K.INTENT_WORDS
) + " ELSE 'help' END"
# DuckDB's word boundary knows ASCII only, so whole words are taken first
_CODES = (
    r"[w FOR w IN regexp_extract_all(upper(replace(text, 'ß', 'ss')), '[\p{L}\p{M}\p{N}_]+')"
    " IF regexp_full_match(w, '[A-Z]{3}')]"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLES = {
    "request_features": f"WITH {LOCATED_SQL} SELECT request_id, {', '.join(R.MODEL_INPUTS)} FROM inputs",
    "request_rejects": f"""WITH {LOCATED_SQL} SELECT request_id, {', '.join(R.REQUEST_FIELDS)},
      array_to_string(faults, '; ') AS faults FROM checked WHERE len(faults) > 0""",
    "route_info": f"""WITH {LOCATED_SQL} SELECT request_id, origin, dest, origin_city, origin_wac, dest_city, dest_wac,
      distance_miles FROM located WHERE origin_city IS NOT NULL AND dest_city IS NOT NULL AND origin <> dest""",
    "explain_rows": f"""WITH {LOCATED_SQL} SELECT request_id, p AS probability_delay_15, risk_band, summary, reasons
      FROM told""",
    "message_intent": f"SELECT conv_id, turn, {_INTENT_SQL} AS tool_name FROM conversations",
    "message_routes": f"""SELECT conv_id, turn, CASE WHEN len({_CODES}) >= 2 THEN ({_CODES})[1] END AS origin,
      CASE WHEN len({_CODES}) >= 2 THEN ({_CODES})[2] END AS dest FROM conversations""",
    "message_answers": f"""WITH {LOCATED_SQL},
      asked AS (SELECT conv_id, turn, {_INTENT_SQL} AS tool_name, t.p, t.summary, t.reasons,
          coalesce(t.origin, CASE WHEN len({_CODES}) >= 2 THEN ({_CODES})[1] END) AS o,
          coalesce(t.dest, CASE WHEN len({_CODES}) >= 2 THEN ({_CODES})[2] END) AS d
        FROM conversations LEFT JOIN told t ON conv_id % 3 = 0 AND t.request_id = conv_id + 1),
      routed AS (SELECT asked.*, a.code AS ac, b.code AS bc, a.wac AS aw, b.wac AS bw,
          round(3958.8 * 2 * atan2(sqrt(h), sqrt(1 - h)), 1) AS miles
        FROM asked LEFT JOIN airports a ON o = a.code LEFT JOIN airports b ON d = b.code
        CROSS JOIN LATERAL (SELECT pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2) AS h))
      SELECT conv_id, turn, tool_name, CASE tool_name
        WHEN 'get_route_info' THEN CASE WHEN o IS NULL THEN {_quoted(K.TEXT_NEED_ROUTE)}
          WHEN ac IS NULL THEN 'Unsupported airport code: ' || o WHEN bc IS NULL THEN 'Unsupported airport code: ' || d
          WHEN o = d THEN 'Origin and destination must be different.'
          ELSE printf('Route %s to %s is about %.1f miles. Origin WAC is %d and destination WAC is %d.', o, d, miles, aw, bw) END
        WHEN 'explain_prediction' THEN CASE WHEN p IS NULL THEN {_quoted(K.TEXT_NEED_FLIGHT_TO_EXPLAIN)}
          ELSE summary || ' ' || reasons END
        WHEN 'predict_delay' THEN CASE WHEN p IS NULL THEN {_quoted(K.TEXT_NEED_FLIGHT_TO_PREDICT)}
          ELSE 'Estimated delay>=15m probability is ' || printf('%.1f%%', p * 100) || '. The current flight is in the '
            || CASE WHEN p >= 0.65 THEN 'high' WHEN p >= 0.35 THEN 'medium' ELSE 'low' END || ' risk band.' END
        ELSE {_quoted(K.TEXT_HELP)} END AS assistant_message,
        CASE tool_name WHEN 'get_route_info' THEN ac IS NULL OR bc IS NULL OR o = d
          WHEN 'explain_prediction' THEN p IS NULL WHEN 'predict_delay' THEN p IS NULL ELSE false END AS failed
      FROM routed""",
}
