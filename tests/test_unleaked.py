"""Delay history without a flight's own or later labels, and counts that come with the write."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ontarmac.operators import features as X, stages, summaries, unleaked as U
from ontarmac.plans import building
from ontarmac.session import own_session
from ontarmac.sources import curated

ROW = "origin string, route string, flight_date date, carrier string, sched_dep_minutes int, label_delay_15 int, split string"


def some_flights(spark, n=400, seed=1):
    rng, start = random.Random(seed), datetime.date(2024, 1, 25)
    rows = []
    for _ in range(n):
        origin = rng.choice(["A", "A", "A", "B", "C", None])
        day = start + datetime.timedelta(rng.randrange(45))
        split = "train" if day < datetime.date(2024, 3, 1) else rng.choice(["valid", "test"])
        route = None if origin is None else origin + rng.choice("xyz")
        rows.append((origin, route, None if rng.random() < 0.02 else day, "c", rng.randrange(1440), rng.choice([0, 1, None]), split))
    rows.append(("D", "Dx", start, "c", 1, 1, "train"))  # the only flight of its key
    return rows, spark.createDataFrame(rows, ROW)


def share(labels):
    known = [v for v in labels if v is not None]
    return sum(known) / len(known) if known else None


def plain(rows, kind):
    out = []
    for i, r in enumerate(rows):
        def rate(key):
            others = [
                o[5] for j, o in enumerate(rows)
                if o[6] == "train" and (key is None or o[key] == r[key])
                and (j != i if kind == "leave_one_out" else o[2] is not None and r[2] is not None and o[2] < r[2] and (key is None or o[key] is not None))
            ]
            return share(others)

        overall = rate(None)
        # under leave-one-out flights without a key are no key of their own
        out.append(tuple(overall if r[k] is None or (found := rate(k)) is None else found for k in (0, 1)))
    return sorted((rows[i], out[i]) for i in range(len(rows)) if rows[i][0] and rows[i][2] and rows[i][5] is not None)


@pytest.mark.parametrize("most", [1000, 0])
@pytest.mark.parametrize("kind", ["leave_one_out", "as_of"])
def test_history_without_own_or_later_labels(spark, kind, most):
    rows, df = some_flights(spark)
    add = U.leave_one_out if kind == "leave_one_out" else U.as_of_day
    got = add(df, max_broadcast_rows=most).select(*df.columns, *U.KEYS.values()).collect()
    assert len(got) == len(rows)
    mine = sorted((tuple(r)[:7], tuple(r)[7:]) for r in got if r["origin"] and r["flight_date"] and r["label_delay_15"] is not None)
    for (a, x), (b, y) in zip(mine, plain(rows, kind), strict=True):
        assert a == b and x == pytest.approx(y)


def test_own_label_has_no_part(spark):
    rows, _ = some_flights(spark, 60)
    flipped = [(*r[:5], 1 - r[5], r[6]) if i == 7 and r[5] is not None else r for i, r in enumerate(rows)]
    rows[7] = (*rows[7][:5], 0, "train")
    flipped[7] = (*rows[7][:5], 1, "train")
    for add in (U.leave_one_out, U.as_of_day):
        a, b = (
            [tuple(r[c] for c in U.KEYS.values()) for r in add(spark.createDataFrame([r], ROW).unionByName(spark.createDataFrame(rest, ROW)))
             .filter((F.col("sched_dep_minutes") == r[4]) & F.col("flight_date").eqNullSafe(F.lit(r[2]))).collect()]
            for r, rest in ((rows[7], rows[:7] + rows[8:]), (flipped[7], rows[:7] + rows[8:]))
        )
        assert a == b


def test_no_window_holds_a_whole_route(spark, flights):
    """Windows run over a key's days of one month, or over its months."""
    table = X.feature_table(flights, 1999, 2000)
    daily = U.daily_counts(table, "route")
    plan = U.before_day(daily, "route")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("month" in line for line in windows)


def test_empty_training_split_is_an_error(spark):
    _, df = some_flights(spark, 20)
    with pytest.raises(ValueError, match="training split is empty"):
        U.leave_one_out(df.filter("split = 'valid'"))
    assert U.as_of_day(df.filter("split = 'valid'")).filter("origin_hist_delay_rate is not null").count() == 0
    with pytest.raises(ValueError, match="unknown history"):
        U.history_feature_table(df, "other")


@pytest.fixture
def root(spark, flights, tmp_path):
    moved = flights.withColumn("Year", (F.col("Year").cast("int") + 24).cast("string")).filter("Year in ('2022', '2023', '2024')")
    path = str(tmp_path / "curated")
    curated.write_curated(moved.withColumnsRenamed({"Year": "year", "Month": "month"}), path)
    return path


def test_counts_come_with_the_write(spark, root, tmp_path):
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("build", "counts")
    counted = building.build_features(spark, root, str(tmp_path / "f"))
    assert len(tracker.getJobIdsForGroup("build")) == 1  # the write, and nothing read back
    context.setJobGroup("", "")
    expected = summaries.split_counts(curated.read_features(spark, str(tmp_path / "f")))
    assert counted.collect() == expected.collect() and counted.dtypes == expected.dtypes


@pytest.mark.parametrize("kind", U.KINDS)
def test_each_history_is_built(spark, root, tmp_path, kind):
    rows = building.build_history_features(spark, root, str(tmp_path / "h"), kind=kind, rates_path=str(tmp_path / "rates")).collect()
    table = spark.read.parquet(str(tmp_path / "h"))
    assert len(table.columns) == 35 and sum(r["count"] for r in rows) == table.count()


def test_rows_of_unknown_splits_are_counted(spark):
    seen = summaries.SplitWatch()
    seen(own_session(spark).createDataFrame([("train",), ("x",), ("x",)], "split string")).collect()
    assert seen.rows() == {"train": 1, "other": 2}


def test_models_are_fitted_after_a_watched_job(spark, root, tmp_path):
    """A session that observes cannot send a freshly fitted forest to tasks, so watched jobs have one of their own."""
    building.build_features(spark, root, str(tmp_path / "f"))
    rows = spark.createDataFrame([(float(i), "a", float(i % 2)) for i in range(40)], "x double, c string, label_delay_15 double")
    model = stages.pipeline("rf", stages.ModelSettings(rf_num_trees=2, rf_max_depth=2), categorical=["c"], numeric=["x"]).fit(rows)
    assert model.transform(rows).select("prediction").count() == len(model.transform(rows).select("prediction").collect())
