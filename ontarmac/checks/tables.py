"""Flights and scoring requests as views over the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac import constants as K
from ontarmac.session import scratch_path
from ontarmac.sources import curated

# the test tables reach from 1995 to 2001
TRAIN_UNTIL = 1999
VALID_UNTIL = 2000

CARRIERS = ["AA", "DL", "UA", "WN", "B6"]
CODES = [a[0] for a in K.AIRPORTS]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _clock(minutes: str) -> str:
    return f"lpad(cast(({minutes}) div 60 * 100 + ({minutes}) % 60 as string), 4, '0')"


def schedules(spark: SparkSession, folder: str) -> DataFrame:
    """One flight per line item, as the few numbers its texts are made of: this is what joins and shuffles move."""
    origin = table(spark, folder, "supplier").selectExpr("s_suppkey", "s_nationkey o_nation")
    dest = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(origin, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(dest, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "cast(l_shipdate as date) day",
            "year(l_shipdate) * 100 + month(l_shipdate) in_month",
            "cast((l_orderkey * 37 + l_partkey * 11) % 1440 as int) dep_m",
            "cast(45 + (l_partkey * 7) % 300 as int) el",
            "cast(100 + (l_partkey * 13) % 2400 as int) dist",
            "cast(l_quantity * 2 - 65 as int) delay",
            "case when l_returnflag = 'R' and l_linenumber in (6, 7) then l_linenumber end lost",
            "p_brand",
            "o_nation",
            "c_nationkey d_nation",
        )
    )


def worded(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """The all-string columns of flights."""
    place = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    origin = place.select(F.col("n_nationkey").alias("o_key"), F.col("r_name").alias("o_region"))
    dest = place.select(F.col("n_nationkey").alias("d_key"), F.col("r_name").alias("d_region"))
    joined = (
        rows.join(F.broadcast(origin), F.col("o_nation") == F.col("o_key"))  # a row per nation
        .join(F.broadcast(dest), F.col("d_nation") == F.col("d_key"))
        .withColumn("arr_m", F.expr("(dep_m + el) % 1440"))
    )
    return joined.selectExpr(
        "cast(year(day) as string) Year",
        "cast(quarter(day) as string) Quarter",
        "cast(month(day) as string) Month",
        "cast(day(day) as string) DayofMonth",
        "cast(weekday(day) + 1 as string) DayOfWeek",
        "cast(day as string) FlightDate",
        f"{_clock('dep_m')} CRSDepTime",
        f"case when arr_m = 0 then '2400' else {_clock('arr_m')} end CRSArrTime",
        "concat(cast(el as string), '.00') CRSElapsedTime",
        "p_brand Reporting_Airline",
        "concat('N', lpad(cast(o_nation as string), 2, '0')) Origin",
        "o_region OriginState",
        "cast(10 + o_nation as string) OriginWac",
        "concat('N', lpad(cast(d_nation as string), 2, '0')) Dest",
        "d_region DestState",
        "cast(10 + d_nation as string) DestWac",
        "concat(cast(dist as string), '.00') Distance",
        "cast(least(11, floor(dist / 250) + 1) as string) DistanceGroup",
        "cast(19000 + cast(substr(p_brand, 7) as int) as string) DOT_ID_Reporting_Airline",
        "cast(10000 + o_nation as string) OriginAirportID",
        "cast(10000 + d_nation as string) DestAirportID",
        "case when lost is not null then null when delay >= 15 then '1.00' else '0.00' end ArrDel15",
        "case when lost is not null then null else concat(cast(delay as string), '.00') end ArrDelay",
        "case when lost = 7 then '1.00' else '0.00' end Cancelled",
        "case when lost = 6 then '1.00' else '0.00' end Diverted",
    )


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """The all-string flight table: one flight per line item."""
    return worded(spark, folder, schedules(spark, folder))


_curated_roots: dict[tuple[str, str], str] = {}


def landed_flights(spark: SparkSession, folder: str) -> DataFrame:
    """The flight table as feature jobs find it: curated Parquet by year and month.

    Written once per application and test folder.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _curated_roots:
        root = scratch_path(spark, "curated-flights")
        monthly = schedules(spark, folder).hint("rebalance", "in_month")  # brought together before there are texts
        dated = worded(spark, folder, monthly).withColumnsRenamed({"Year": "year", "Month": "month"})
        curated.write_curated(dated, root)
        _curated_roots[key] = root
    return curated.read_curated(spark, _curated_roots[key])


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests: one per order, some of them faulty."""
    codes = "array(" + ", ".join(f"'{c}'" for c in CODES) + ")"
    carriers = "array(" + ", ".join(f"'{c}'" for c in CARRIERS) + ")"
    dep = "((o_orderkey * 37) % 1440)"
    arr = "((o_orderkey * 37 + 45 + (o_custkey * 7) % 300) % 1440)"
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey request_id",
        "case o_orderkey % 6 when 1 then ' RF ' when 2 then 'lr' when 3 then 'gbt' when 4 then '  ' end model_id",
        "case when o_orderkey % 101 = 0 then 1986 else year(o_orderdate) end year",
        "case when o_orderkey % 97 = 0 then 13 else month(o_orderdate) end month",
        "case when o_orderkey % 79 = 0 then 31 when o_orderkey % 73 = 0 then null else day(o_orderdate) end day_of_month",
        "case when o_orderkey % 71 = 0 then 0 else weekday(o_orderdate) + 1 end day_of_week",
        "case when o_orderkey % 67 = 0 then 'A' when o_orderkey % 61 = 0 then null"
        f" when o_orderkey % 11 = 0 then concat(' ', lower(element_at({carriers}, cast(o_custkey % 5 as int) + 1)))"
        f" else element_at({carriers}, cast(o_custkey % 5 as int) + 1) end carrier",
        f"case when o_orderkey % 83 = 0 then 'ZZZ' else element_at({codes}, cast(o_orderkey % 26 as int) + 1) end origin",
        f"case when o_orderkey % 59 = 0 then ' SF' when o_orderkey % 13 = 0"
        f" then lower(element_at({codes}, cast((o_custkey * 7) % 26 as int) + 1))"
        f" else element_at({codes}, cast((o_custkey * 7) % 26 as int) + 1) end dest",
        f"cast(case when o_orderkey % 89 = 0 then 1275 else {dep} div 60 * 100 + {dep} % 60 end as int) crs_dep_time",
        f"cast({arr} div 60 * 100 + {arr} % 60 as int) crs_arr_time",
    )


def listing_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Archive listing lines: one per order, in both file name variants."""
    return table(spark, folder, "orders").selectExpr(
        "concat(month(o_orderdate), '/', least(day(o_orderdate), 28), '/', 2000 + o_orderkey % 20, '  ',"
        " 1 + o_orderkey % 12, ':', lpad(cast(o_orderkey % 60 as string), 2, '0'),"
        " case when o_orderkey % 2 = 0 then ' AM' else ' PM' end, '   ', cast(o_totalprice as bigint) % 50000,"
        " '  <A HREF=\"', case when o_orderkey % 5 = 0 then '' else '/PREZIP/' end,"
        " 'On_Time_Reporting_Carrier_On_Time_Performance',"
        " case when o_orderkey % 3 = 0 then '_(1987_present)_' else '_1987_present_' end,"
        " year(o_orderdate), '_', month(o_orderdate),"
        " case when o_orderkey % 41 = 0 then '.txt' else '.zip' end, '\">') line"
    )


# --- SQL -------------------------------------------------------------------------------------------

_DUCK_DEP = "(lpad(cast((dep_m // 60) * 100 + dep_m % 60 as varchar), 4, '0'))"
_DUCK_ARR = "(lpad(cast((arr_m // 60) * 100 + arr_m % 60 as varchar), 4, '0'))"

FLIGHTS_SQL = f"""
base AS (
  SELECT l.*, p_brand, s_nationkey AS o_nation, c_nationkey AS d_nation, ro.r_name AS o_region, rd.r_name AS d_region,
    (l_orderkey * 37 + l_partkey * 11) % 1440 AS dep_m,
    45 + (l_partkey * 7) % 300 AS el,
    ((l_orderkey * 37 + l_partkey * 11) % 1440 + 45 + (l_partkey * 7) % 300) % 1440 AS arr_m,
    100 + (l_partkey * 13) % 2400 AS dist,
    cast(l_quantity * 2 - 65 AS int) AS delay
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation no ON s_nationkey = no.n_nationkey JOIN region ro ON no.n_regionkey = ro.r_regionkey
  JOIN nation nd ON c_nationkey = nd.n_nationkey JOIN region rd ON nd.n_regionkey = rd.r_regionkey
),
flights AS (
  SELECT cast(year(l_shipdate) AS varchar) AS "Year", cast(quarter(l_shipdate) AS varchar) AS "Quarter",
    cast(month(l_shipdate) AS varchar) AS "Month", cast(day(l_shipdate) AS varchar) AS "DayofMonth",
    cast(isodow(l_shipdate) AS varchar) AS "DayOfWeek", substr(cast(l_shipdate AS varchar), 1, 10) AS "FlightDate",
    {_DUCK_DEP} AS "CRSDepTime", CASE WHEN arr_m = 0 THEN '2400' ELSE {_DUCK_ARR} END AS "CRSArrTime",
    concat(el, '.00') AS "CRSElapsedTime", p_brand AS "Reporting_Airline",
    concat('N', lpad(cast(o_nation AS varchar), 2, '0')) AS "Origin", o_region AS "OriginState",
    cast(10 + o_nation AS varchar) AS "OriginWac", concat('N', lpad(cast(d_nation AS varchar), 2, '0')) AS "Dest",
    d_region AS "DestState", cast(10 + d_nation AS varchar) AS "DestWac", concat(dist, '.00') AS "Distance",
    cast(least(11, dist // 250 + 1) AS varchar) AS "DistanceGroup",
    cast(19000 + cast(substr(p_brand, 7) AS int) AS varchar) AS "DOT_ID_Reporting_Airline",
    cast(10000 + o_nation AS varchar) AS "OriginAirportID", cast(10000 + d_nation AS varchar) AS "DestAirportID",
    CASE WHEN l_returnflag = 'R' AND l_linenumber IN (6, 7) THEN NULL WHEN delay >= 15 THEN '1.00' ELSE '0.00' END AS "ArrDel15",
    CASE WHEN l_returnflag = 'R' AND l_linenumber IN (6, 7) THEN NULL ELSE concat(delay, '.00') END AS "ArrDelay",
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '1.00' ELSE '0.00' END AS "Cancelled",
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN '1.00' ELSE '0.00' END AS "Diverted"
  FROM base
)"""


def sql_int(column: str) -> str:
    return f"cast(trunc(try_cast({column} AS double)) AS integer)"


VALID_SQL = FLIGHTS_SQL + """,
valid AS (
  SELECT * FROM flights
  WHERE try_cast("Cancelled" AS double) = 0 AND try_cast("Diverted" AS double) = 0
    AND "ArrDel15" IS NOT NULL AND "ArrDelay" IS NOT NULL AND "CRSDepTime" IS NOT NULL AND "CRSArrTime" IS NOT NULL
    AND "CRSElapsedTime" IS NOT NULL AND "Distance" IS NOT NULL AND "Reporting_Airline" IS NOT NULL
    AND "Origin" IS NOT NULL AND "Dest" IS NOT NULL
)"""

FEATURES_SQL = VALID_SQL + f""",
timed AS (
  SELECT *, cast(substr("CRSDepTime", 1, 2) AS int) * 60 + cast(substr("CRSDepTime", 3, 2) AS int) AS dm,
    cast(substr("CRSArrTime", 1, 2) AS int) * 60 + cast(substr("CRSArrTime", 3, 2) AS int) AS am,
    cast("FlightDate" AS date) AS fd
  FROM valid
),
features AS (
  SELECT {sql_int('"Year"')} AS year, {sql_int('"Quarter"')} AS quarter, {sql_int('"Month"')} AS month,
    {sql_int('"DayofMonth"')} AS day_of_month, {sql_int('"DayOfWeek"')} AS day_of_week, fd AS flight_date,
    cast(dayofyear(fd) AS integer) AS day_of_year, cast(weekofyear(fd) AS integer) AS week_of_year,
    CASE WHEN {sql_int('"DayOfWeek"')} IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN {sql_int('"Month"')} IN (12, 1, 2) THEN 'winter' WHEN {sql_int('"Month"')} IN (3, 4, 5) THEN 'spring'
         WHEN {sql_int('"Month"')} IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
    dm AS sched_dep_minutes, am AS sched_arr_minutes, dm // 60 AS sched_dep_hour, am // 60 AS sched_arr_hour,
    CASE WHEN dm // 60 < 6 THEN 'overnight' WHEN dm // 60 < 12 THEN 'morning' WHEN dm // 60 < 18 THEN 'afternoon'
         ELSE 'evening' END AS dep_time_bucket,
    "Reporting_Airline" AS carrier, "Origin" AS origin, "OriginState" AS origin_state, {sql_int('"OriginWac"')} AS origin_wac,
    "Dest" AS dest, "DestState" AS dest_state, {sql_int('"DestWac"')} AS dest_wac,
    concat("Origin", '_', "Dest") AS route, concat("Reporting_Airline", '_', "Origin", '_', "Dest") AS carrier_route,
    cast("CRSElapsedTime" AS double) AS scheduled_elapsed_time, cast("Distance" AS double) AS distance,
    {sql_int('"DistanceGroup"')} AS distance_group, {sql_int('"DOT_ID_Reporting_Airline"')} AS dot_id_reporting_airline,
    {sql_int('"OriginAirportID"')} AS origin_airport_id, {sql_int('"DestAirportID"')} AS dest_airport_id,
    {sql_int('"ArrDel15"')} AS label_delay_15, cast("ArrDelay" AS double) AS arrival_delay_minutes,
    CASE WHEN {sql_int('"Year"')} <= {TRAIN_UNTIL} THEN 'train' WHEN {sql_int('"Year"')} = {VALID_UNTIL} THEN 'valid'
         ELSE 'test' END AS split
  FROM timed
)"""


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


REQUESTS_SQL = f"""
requests AS (
  SELECT o_orderkey AS request_id,
    CASE o_orderkey % 6 WHEN 1 THEN ' RF ' WHEN 2 THEN 'lr' WHEN 3 THEN 'gbt' WHEN 4 THEN '  ' END AS model_id,
    CASE WHEN o_orderkey % 101 = 0 THEN 1986 ELSE cast(year(o_orderdate) AS integer) END AS year,
    CASE WHEN o_orderkey % 97 = 0 THEN 13 ELSE cast(month(o_orderdate) AS integer) END AS month,
    CASE WHEN o_orderkey % 79 = 0 THEN 31 WHEN o_orderkey % 73 = 0 THEN NULL
      ELSE cast(day(o_orderdate) AS integer) END AS day_of_month,
    CASE WHEN o_orderkey % 71 = 0 THEN 0 ELSE cast(isodow(o_orderdate) AS integer) END AS day_of_week,
    CASE WHEN o_orderkey % 67 = 0 THEN 'A' WHEN o_orderkey % 61 = 0 THEN NULL
      WHEN o_orderkey % 11 = 0 THEN ' ' || lower(({_sql_list(CARRIERS)})[o_custkey % 5 + 1])
      ELSE ({_sql_list(CARRIERS)})[o_custkey % 5 + 1] END AS carrier_sent,
    CASE WHEN o_orderkey % 83 = 0 THEN 'ZZZ' ELSE ({_sql_list(CODES)})[o_orderkey % 26 + 1] END AS origin,
    CASE WHEN o_orderkey % 59 = 0 THEN ' SF' WHEN o_orderkey % 13 = 0 THEN lower(({_sql_list(CODES)})[(o_custkey * 7) % 26 + 1])
      ELSE ({_sql_list(CODES)})[(o_custkey * 7) % 26 + 1] END AS dest_sent,
    upper(trim(carrier_sent)) AS carrier, upper(trim(dest_sent)) AS dest,
    cast(CASE WHEN o_orderkey % 89 = 0 THEN 1275
      ELSE ((o_orderkey * 37) % 1440) // 60 * 100 + ((o_orderkey * 37) % 1440) % 60 END AS integer) AS crs_dep_time,
    cast(((o_orderkey * 37 + 45 + (o_custkey * 7) % 300) % 1440) // 60 * 100
      + ((o_orderkey * 37 + 45 + (o_custkey * 7) % 300) % 1440) % 60 AS integer) AS crs_arr_time
  FROM orders
)"""

AIRPORTS_SQL = (
    "airports(code, wac, lat, lon, city) AS (VALUES "
    + ", ".join(f"('{c}', {w}, {lat}::double, {lon}::double, '{city}')" for c, w, lat, lon, city in K.AIRPORTS)
    + ")"
)

LISTING_SQL = """
lines AS (
  SELECT concat(month(o_orderdate), '/', least(day(o_orderdate), 28), '/', 2000 + o_orderkey % 20, '  ',
    1 + o_orderkey % 12, ':', lpad(cast(o_orderkey % 60 AS varchar), 2, '0'),
    CASE WHEN o_orderkey % 2 = 0 THEN ' AM' ELSE ' PM' END, '   ', cast(trunc(o_totalprice) AS bigint) % 50000,
    '  <A HREF="', CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '/PREZIP/' END,
    'On_Time_Reporting_Carrier_On_Time_Performance',
    CASE WHEN o_orderkey % 3 = 0 THEN '_(1987_present)_' ELSE '_1987_present_' END,
    year(o_orderdate), '_', month(o_orderdate),
    CASE WHEN o_orderkey % 41 = 0 THEN '.txt' ELSE '.zip' END, '">') AS line
  FROM orders
)"""
