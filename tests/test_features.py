import pytest
from pyspark.sql import functions as F

from ontarmac import constants as K
from ontarmac.operators import features as X, history as H, sampling
from ontarmac.sources import curated


@pytest.fixture(scope="module")
def curated_root(flights, tmp_path_factory):
    """Folders by month whose files keep Year and Month too, as one write per month leaves them."""
    root = tmp_path_factory.mktemp("curated")
    for year, month in ((1998, 2), (1998, 3), (2000, 2)):
        part = flights.filter((F.col("Year") == str(year)) & (F.col("Month") == str(month)))
        part.write.parquet(f"{root}/year={year}/month={month:02d}")
    return str(root)


def features_of(df):
    return X.feature_table(df, 1999, 2000)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_schema(flights):
    table = features_of(flights)
    assert len(table.columns) == 33
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    assert kinds["year"] == "int" and kinds["flight_date"] == "date" and kinds["distance"] == "double"
    assert sum(k == "int" for k in kinds.values()) == 19 and sum(k == "string" for k in kinds.values()) == 10


def test_root_year_and_month_reads_agree(spark, flights, curated_root):
    root = spark.read.parquet(curated_root)
    year = spark.read.parquet(f"{curated_root}/year=1998")
    month = spark.read.parquet(f"{curated_root}/year=1998/month=02")
    chosen = flights.filter("Year = '1998' and Month = '2'")
    for read in (root.filter("year = 1998 and month = 2"), year.filter("month = 2"), month):
        assert same(features_of(read), features_of(chosen))


def test_reading_below_the_root_keeps_year_and_month(spark, curated_root):
    leaf = curated.read_curated(spark, f"{curated_root}/year=1998/month=02/")
    assert dict(leaf.dtypes)["year"] == "int" and dict(leaf.dtypes)["month"] == "int"


def test_year_window_prunes_folders(spark, curated_root):
    plan = X.years_in(spark.read.parquet(curated_root), [1998])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_missing_columns_are_named(flights):
    with pytest.raises(ValueError, match="Diverted"):
        X.feature_table(flights.drop("Diverted"))


def test_filter_on_text_flags(spark, flights):
    row = flights.filter("Cancelled = '0.00' and Diverted = '0.00'").limit(1)
    for flag, kept in (("0", 1), ("0.00", 1), ("1.00", 0), ("x", 0), (None, 0)):
        assert X.valid_flights(row.withColumn("Cancelled", F.lit(flag).cast("string"))).count() == kept
    for column in K.REQUIRED_VALUES:
        assert X.valid_flights(row.withColumn(column, F.lit(None).cast("string"))).count() == 0


def test_unknown_values_fall_to_the_last_case(flights):
    odd = flights.limit(1).withColumns({c: F.lit(None).cast("string") for c in ("Year", "Month", "CRSDepTime")})
    row = X.with_label_and_split(X.with_calendar(X.with_schedule(odd))).first()
    assert (row["split"], row["season"], row["dep_time_bucket"]) == ("test", "fall", "evening")


def test_preview_shows_the_columns_that_exist(flights):
    assert curated.preview(flights).columns == ["Year", "Month", "Origin", "Dest", "ArrDelay"]
    assert curated.preview(flights.select("Distance"), 2).collect()[0].asDict().keys() == {"Distance"}
    assert curated.table_shape(flights)["columns"] == 25


def test_history_joins_agree(spark, flights):
    """Broadcast and salted lookups give the same rates, with one origin on a third of the rows."""
    skewed = flights.withColumn("Origin", F.when(F.crc32("CRSDepTime") % 3 == 0, "HOT").otherwise(F.col("Origin")))
    small = H.history_feature_table(skewed, 1999, 2000)
    large = H.history_feature_table(skewed, 1999, 2000, max_broadcast_rows=0)
    assert len(small.columns) == 35
    assert same(small, large)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert same(small, large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_of_broadcast_rates_moves_no_flights(spark, curated_root):
    table = H.history_feature_table(spark.read.parquet(curated_root), 1999, 2000)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_history_learns_from_training_rows_only(spark):
    rows = [("A", "A_B", 1, "train"), ("A", "A_C", 0, "train"), ("D", "D_A", None, "train"),
            ("A", "A_B", 0, "test"), ("E", "E_F", 1, "test"), (None, None, 1, "valid")]
    df = spark.createDataFrame(rows, "Origin string, route string, label_delay_15 int, split string")
    for limit in (10, 0):
        got = {(r["Origin"], r["route"], r["split"]): (r["origin_hist_delay_rate"], r["route_hist_delay_rate"])
               for r in H.with_delay_history(df, max_broadcast_rows=limit).collect()}
        assert got[("A", "A_B", "train")] == (0.5, 1.0)
        assert got[("A", "A_B", "test")] == (0.5, 1.0)
        assert got[("D", "D_A", "train")] == (0.5, 0.5)
        assert got[("E", "E_F", "test")] == (0.5, 0.5)
        assert got[(None, None, "valid")] == (0.5, 0.5)


def test_history_needs_training_rows(flights):
    with pytest.raises(ValueError, match="training split is empty"):
        H.history_feature_table(flights, 1990, 1991)


def test_hash_sample_ignores_the_partitioning(flights):
    key = ["FlightDate", "Reporting_Airline", "Origin", "Dest", "CRSDepTime"]
    drawn = sampling.hash_sample(flights, 0.1, key, 42)
    assert same(drawn, sampling.hash_sample(flights.repartition(7), 0.1, key, 42))
    assert 0.05 < drawn.count() / flights.count() < 0.15
    assert not same(drawn, sampling.hash_sample(flights, 0.1, key, 43))
    assert sampling.hash_sample(flights, 1.0, key, 42) is flights


def test_split_samples(flights):
    parts = sampling.split_samples(features_of(flights), 0.5, 1.0, 1.0)
    assert {name: part.select("split").distinct().collect()[0][0] for name, part in parts.items()} == {
        "train": "train", "valid": "valid", "test": "test"}
    assert 0 < parts["train"].count() < X.of_split(features_of(flights), "train").count()


def test_dev_subset(flights):
    assert sampling.dev_subset(flights).count() == 0
    assert 0 < sampling.dev_subset(flights, [1998, 1999, 2000]).count() < 0.1 * flights.count()


def test_feature_sink(spark, flights, tmp_path):
    path = str(tmp_path / "features")
    curated.write_features(features_of(flights), path)
    back = curated.read_features(spark, path)
    assert back.columns[-3:] == ["split", "year", "month"]
    assert same(back.select(*X.FEATURE_COLUMNS), features_of(flights))
    with pytest.raises(Exception, match="already exists"):
        curated.write_features(features_of(flights), path)
    curated.write_features(features_of(flights).limit(5), path, overwrite=True, rebalance=True)
    assert spark.read.parquet(path).count() == 5


def test_shuffled_history_reads_the_needed_columns_only(spark, flights, tmp_path):
    wide = flights.withColumns({f"unused{i}": F.lit("x") for i in range(5)})
    wide.write.parquet(str(tmp_path / "wide"))
    table = H.history_feature_table(spark.read.parquet(str(tmp_path / "wide")), 1999, 2000, max_broadcast_rows=0)
    assert "unused" not in table._jdf.queryExecution().executedPlan().toString()
