import pytest
from pyspark.sql import functions as F

from ontarmac.functions import calendar, clock, geo, text
from ontarmac.functions.casts import day, number


def values(spark, expression, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_numbers_and_dates(spark):
    assert values(spark, number("x"), ["1.00", "0.00", "7", "x", "", None, "99999999999"]) == [1, 0, 7, None, None, None, None]
    assert values(spark, day("x").cast("string"), ["2024-02-29", "2023-02-30", "x", None]) == ["2024-02-29", None, None, None]


def test_clock(spark):
    times = ["0", "5", "0005", "2359", "2400", "1205.00", "12345", None, "x"]
    assert values(spark, clock.hhmm_to_minutes("x"), times) == [0, 5, 5, 1439, 1440, 725, 754, None, None]
    assert values(spark, clock.hour_of("x"), [0, 59, 60, 1439, 1440, None], "int") == [0, 0, 1, 23, 24, None]
    parts = ["overnight", "overnight", "morning", "morning", "afternoon", "evening", "evening", "evening"]
    assert values(spark, clock.part_of_day("x"), [0, 5, 6, 11, 12, 18, 24, None], "int") == parts


@pytest.mark.parametrize(("dep", "arr", "minutes"), [(900, 900, 1440), (2330, 30, 60), (800, 1015, 135), (0, 2359, 1439)])
def test_elapsed(spark, dep, arr, minutes):
    assert spark.range(1).select(clock.elapsed_minutes(F.lit(dep), F.lit(arr))).first()[0] == minutes


def test_clock_limits(spark):
    assert values(spark, clock.is_clock_time("x"), [0, 2359, 2360, 2400, 1275, -1], "int") == [True, True] + [False] * 4


def test_calendar(spark):
    dates = ["2024-12-30", "2023-01-01", "2020-12-31"]
    assert values(spark, F.weekofyear(day("x")), dates) == [1, 52, 53]
    assert values(spark, F.dayofyear(day("x")), dates) == [365, 1, 366]
    seasons = ["winter", "winter", "spring", "summer", "fall", "winter", "fall"]
    assert values(spark, calendar.season("x"), [1, 2, 5, 8, 9, 12, None], "int") == seasons
    assert values(spark, calendar.quarter_of("x"), [1, 3, 4, 12], "int") == [1, 1, 2, 4]
    assert values(spark, calendar.is_weekend("x"), [1, 5, 6, 7, None], "int") == [0, 0, 1, 1, None]
    made = spark.range(1).select(
        calendar.date_of(F.lit(2024), F.lit(2), F.lit(29)), calendar.date_of(F.lit(2023), F.lit(2), F.lit(29))
    ).first()
    assert (str(made[0]), made[1]) == ("2024-02-29", None)


def test_distance(spark):
    assert values(spark, geo.distance_group("x"), [0.0, 250.0, 250.1, 6000.0], "double") == [1, 1, 2, 24]
    sfo_jfk = [F.lit(v) for v in (37.6213, -122.3790, 40.6413, -73.7781)]
    miles = spark.range(1).select(geo.great_circle_miles(*sfo_jfk)).first()[0]
    assert miles == pytest.approx(2580, abs=10) and round(miles, 1) == miles


def test_codes_and_bands(spark):
    assert values(spark, text.code("x"), [" sfo\n", "b6"]) == ["SFO", "B6"]
    assert values(spark, text.model_key("x"), [" RF ", "  ", None]) == ["rf", None, None]
    assert values(spark, text.risk_band("x"), [0.65, 0.6499, 0.35, 0.3499], "double") == ["high", "medium", "medium", "low"]
    assert values(spark, text.percent("x"), [0.1234, 0.3125, 0.0, 1.0], "double") == ["12.3%", "31.2%", "0.0%", "100.0%"]


def test_messages(spark):
    said = ["What is the ROUTE?", "why is it late", "is it late", "hello", "explain the distance"]
    tools = ["get_route_info", "explain_prediction", "predict_delay", "help", "get_route_info"]
    assert values(spark, text.intent("x"), said) == tools
    codes = [["SFO", "JFK"], ["FOR", "THE"], [], []]
    assert values(spark, text.named_codes("x"), ["sfo to JFK!", "for the flight", "élan été", "ABCD EF"]) == codes


def test_percent_rounds_the_exact_value(spark):
    shown = spark.range(10001).select((F.col("id") / 10000).alias("p")).select("p", text.percent("p").alias("shown")).collect()
    assert all(r["shown"] == f"{r['p']:.1%}" for r in shown)
    assert values(spark, text.percent("x"), [0.0025, 0.0075, 0.00125, 1.0, None], "double") == ["0.2%", "0.8%", "0.1%", "100.0%", None]
