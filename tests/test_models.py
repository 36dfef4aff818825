import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ontarmac import constants as K, session
from ontarmac.checks import tables
from ontarmac.operators import evaluation as E, features as X, history, leaderboard as L, scoring as R, stages
from ontarmac.plans import serving, training

SETTINGS = stages.ModelSettings(max_iter=5, rf_num_trees=3, rf_max_depth=3, gbt_max_iter=2, gbt_max_depth=2)


@pytest.fixture(scope="module")
def table(flights):
    return X.feature_table(flights, 1999, 2000).cache()


@pytest.fixture(scope="module")
def comparison(table):
    return training.compare(table, "lr, RF,gbt", train_fraction=1.0, valid_fraction=1.0, test_fraction=1.0, settings=SETTINGS)


def predictions(table, score):
    return table.select("split", K.LABEL, F.expr(score).alias("score")).withColumns(
        {"prediction": (F.col("score") >= 0.5).cast("double"),
         "rawPrediction": array_to_vector(F.array(1 - F.col("score"), F.col("score")))}
    )


@pytest.mark.parametrize("score", [
    "((sched_dep_minutes * 31 + day_of_year * 7) % 1009) / 1009.0D",
    "(sched_dep_hour % 5) / 4.0D",
    "arrival_delay_minutes / 100.0D",
    "0.7D",
])
def test_metrics_match_the_evaluators(table, score):
    scored = predictions(table, score)
    for slices in (2, 8, 256):
        rows = {r["split"]: r for r in E.evaluate(scored, ["split"], E.class_score(), slices=slices).collect()}
        for split in ("valid", "test"):
            part = X.of_split(scored, split)
            for name, kind in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
                exact = BinaryClassificationEvaluator(labelCol=K.LABEL, metricName=kind, numBins=0).evaluate(part)
                binned = BinaryClassificationEvaluator(labelCol=K.LABEL, metricName=kind).evaluate(part)
                assert rows[split][name] == pytest.approx(exact, abs=1e-12)
                assert rows[split][name] == pytest.approx(binned, abs=2e-3)
            if slices == 2:
                for name, kind in (("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
                    expected = MulticlassClassificationEvaluator(labelCol=K.LABEL, metricName=kind).evaluate(part)
                    assert rows[split][name] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize(("label", "expected"), [(1, (1.0, 1.0)), (0, (0.0, 0.0))])
def test_metrics_of_a_single_class(table, label, expected):
    scored = predictions(table.filter(F.col(K.LABEL) == label), "sched_dep_hour / 24.0D")
    row = E.evaluate(scored, ["split"], "score").filter("split = 'test'").first()
    assert (row["roc_auc"], row["pr_auc"]) == expected
    part = X.of_split(scored, "test")
    for name, kind in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        exact = BinaryClassificationEvaluator(labelCol=K.LABEL, metricName=kind, numBins=0).evaluate(part)
        assert row[name] == pytest.approx(exact)


def board(spark, scores, trained):
    rows = [(m, "valid", "pr_auc", s, "valid_pr_auc") for m, s in scores.items()]
    long = spark.createDataFrame(rows, "model_name string, split string, metric string, value double, metric_name string")
    return L.leaderboard(long, trained)


def test_first_trained_wins_ties(spark):
    for trained in (["lr", "rf"], ["rf", "lr"]):
        ranked = board(spark, {"lr": 0.3, "rf": 0.3}, trained)
        assert [r["model_name"] for r in ranked.orderBy("rank").collect()] == trained
        assert L.champion(ranked) == trained[0]


def test_nan_never_wins(spark):
    ranked = board(spark, {"lr": math.nan, "rf": 0.1}, ["lr", "rf"])
    assert [(r["model_name"], r["selection_status"]) for r in ranked.orderBy("rank").collect()] == [
        ("rf", "champion"), ("lr", "challenger")]
    with pytest.raises(RuntimeError):
        L.champion(board(spark, {"lr": math.nan}, ["lr"]))


def test_names_and_metrics_are_checked(spark):
    assert stages.model_names(" LR, gbt,") == ["lr", "gbt"]
    for wrong in ("", "lr,svm"):
        with pytest.raises(ValueError):
            stages.model_names(wrong)
    with pytest.raises(ValueError):
        L.selection_metric("valid_recall")
    defaults = stages.ModelSettings()
    assert (defaults.max_iter, defaults.rf_num_trees, defaults.rf_max_depth) == (30, 80, 10)
    assert (defaults.gbt_max_iter, defaults.gbt_max_depth) == (40, 6)


def test_unseen_and_missing_categories_share_a_slot(spark):
    seen = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("c", 4)], "kind string, n int")
    model = Pipeline(stages=stages.feature_stages(["kind"], ["n"])).fit(seen)
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("z", 1), (None, None)], "kind string, n int")
    vectors = [r[0] for r in model.transform(rows).select(vector_to_array("features")).collect()]
    assert [v[1:].index(1.0) for v in vectors] == [0, 2, 1, 3, 3]
    assert all(len(v) == 5 for v in vectors) and math.isnan(vectors[4][0])


def test_comparison(comparison, table):
    assert list(comparison.models) == ["lr", "rf", "gbt"]
    assert comparison.sampled_rows == {r["split"]: r["count"] for r in table.groupBy("split").count().collect()}
    rows = comparison.metrics.collect()
    assert len(rows) == 30 and all(0 <= r["value"] <= 1 for r in rows)
    assert comparison.champion in comparison.models
    assert comparison.board.count() == 3
    for shown in comparison.previews.values():
        assert shown.count() == 10 and shown.select("split").distinct().collect()[0][0] == "valid"


def test_history_columns_can_be_model_inputs_and_be_served(spark, folder, flights, tmp_path):
    table = history.history_feature_table(flights, 1999, 2000)
    result = training.compare(
        table, "rf", "test_f1", min_year=1999, train_fraction=1.0, valid_fraction=1.0, test_fraction=0.5,
        settings=SETTINGS, numeric=K.NUMERIC_COLUMNS + K.HISTORY_COLUMNS)
    assembler = result.models["rf"].stages[2]
    assert assembler.getInputCols()[17:19] == K.HISTORY_COLUMNS
    assert result.sampled_rows["train"] == table.filter("year = 1999").count()
    assert result.board.first()["selection_score"] == result.board.first()["test_f1"]
    training.write_reports(result, str(tmp_path / "reports"))
    listed = spark.read.json(str(tmp_path / "reports/feature_schema")).first()
    assert set(K.HISTORY_COLUMNS) <= set(listed["numeric_cols"])
    history.learn_rates(X.derive(flights, 1999, 2000)).save(str(tmp_path / "rates"))
    kept = history.DelayRates.load(spark, str(tmp_path / "rates"))
    requests = tables.requests(spark, folder)
    scored, rejects = serving.score_requests(requests, result.models, "rf", kept)
    assert scored.count() + rejects.count() == requests.count() and scored.count() > 0


def test_comparing_leaves_no_scratch_files(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    training.compare(table, "lr", train_fraction=0.3, valid_fraction=0.3, test_fraction=0.3, settings=SETTINGS)
    assert not list(tmp_path.iterdir())


def test_shared_stages_give_the_same_model_as_a_pipeline(comparison, table):
    whole = stages.pipeline("rf", SETTINGS).fit(X.of_split(table, "train"))
    held_out = X.of_split(table, "test")
    mine, theirs = (m.transform(held_out).select(E.class_score("probability")) for m in (comparison.models["rf"], whole))
    assert mine.exceptAll(theirs).isEmpty()


def test_models_are_saved_once_and_loaded_when_asked_for(comparison, tmp_path, table):
    path = str(tmp_path / "best")
    assert training.export_champion(comparison, path) == comparison.champion
    with pytest.raises(Exception, match="already exists"):
        training.export_champion(comparison, path)
    training.export_champion(comparison, path, overwrite=True)
    shelf = training.ModelShelf({"best": path, "gone": str(tmp_path / "gone")}, "best")
    assert shelf.get(" BEST ") is shelf.get() is shelf.get("")
    with pytest.raises(ValueError, match="Unsupported model_id: nope"):
        shelf.get("nope")
    with pytest.raises(ValueError):
        training.ModelShelf({"best": path}, "other")
    row = X.of_split(table, "test").limit(1)
    assert shelf.get().transform(row).select("prediction").count() == 1


def test_reports(spark, comparison, tmp_path):
    training.write_reports(comparison, str(tmp_path))
    board = spark.read.json(f"{tmp_path}/leaderboard").orderBy("rank").collect()
    assert board[0]["model_name"] == comparison.champion
    assert spark.read.json(f"{tmp_path}/feature_schema").first()["selected_models"] == ["lr", "rf", "gbt"]
    assert spark.read.json(f"{tmp_path}/lr_valid_predictions").count() == 10


def test_scoring(spark, folder, comparison):
    requests = tables.requests(spark, folder).withColumn(
        "model_id", F.expr("element_at(array(null, ' RF ', 'lr', 'nope'), cast(request_id % 4 as int) + 1)"))
    scored, rejects = serving.score_requests(requests, {m: comparison.models[m] for m in ("lr", "rf")}, "lr")
    assert scored.count() + rejects.count() == requests.count()
    assert scored.filter("probability_delay_15 not between 0 and 1").isEmpty()
    models = {(r["request_id"] % 4, r["model_id"]) for r in scored.select("request_id", "model_id").collect()}
    assert models == {(0, "lr"), (1, "rf"), (2, "lr")}
    assert scored.filter(F.size("reasons") == 0).isEmpty()
    assert not rejects.filter(F.array_contains("faults", "Unsupported model_id: nope")).isEmpty()
    with pytest.raises(ValueError):
        serving.score_requests(requests, {"lr": comparison.models["lr"]}, "rf")


def test_request_faults(spark):
    good = dict(request_id="1", model_id=None, year=2024, month=2, day_of_month=29, day_of_week=7, carrier=" aa",
                origin="sfo", dest="JFK", crs_dep_time=900, crs_arr_time=1730)
    changes = [{}, {"day_of_month": 30}, {"origin": "sf"}, {"dest": "SFO"}, {"dest": "ZZZ"}, {"crs_arr_time": 2400},
               {"crs_dep_time": 1060}, {"year": 1986, "day_of_week": 0}, {"carrier": None}, {"carrier": "x"}]
    rows = [good | change | {"request_id": str(i)} for i, change in enumerate(changes)]
    checked = R.with_faults(spark.createDataFrame(rows, R.REQUEST_SCHEMA))
    faults = {int(r["request_id"]): r["faults"] for r in checked.collect()}
    assert faults == {
        0: [],
        1: ["no such date"],
        2: ["origin must have 3 characters"],
        3: ["Origin and destination must be different."],
        4: ["Unsupported airport code: ZZZ"],
        5: ["crs_arr_time must be a time in HHMM format"],
        6: ["crs_dep_time must be a time in HHMM format"],
        7: ["year must be from 1987 to 2100", "day_of_week must be from 1 to 7"],
        8: ["carrier is missing"],
        9: ["carrier must have 2 to 10 characters"],
    }
    inputs = R.model_inputs(R.accepted(checked)).first()
    assert (inputs["carrier"], inputs["origin"], inputs["day_of_year"], inputs["quarter"]) == ("AA", "SFO", 60, 1)
    assert inputs["scheduled_elapsed_time"] == 510.0 and inputs["distance_group"] == 11
    kinds = {f.name: f.dataType for f in R.model_inputs(checked).schema}
    assert {f.name: f.dataType for f in R.MODEL_INPUT_SCHEMA} == {c: kinds[c] for c in R.MODEL_INPUTS}


def test_reasons(spark):
    rows = [("evening", 1500.0, "summer", 1), ("morning", 1499.9, "fall", 0), ("overnight", 10.0, "fall", 0)]
    df = spark.createDataFrame(rows, "dep_time_bucket string, distance double, season string, is_weekend int")
    reasons = [r["reasons"] for r in R.explain(df.withColumn("probability_delay_15", F.lit(0.5))).collect()]
    assert reasons == [
        [K.REASON_LATE_IN_DAY, K.REASON_LONG_HAUL, K.REASON_SEASON, K.REASON_WEEKEND],
        [K.REASON_NONE],
        [K.REASON_LATE_IN_DAY],
    ]


def test_requests_from_json(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"request_id": "1", "year": 2024, "month": "x", "carrier": "AA"}\n{"request_id": "2", "year": 2024, "month": 5}\n')
    rows = {r["request_id"]: r for r in R.with_faults(serving.read_requests(spark, str(tmp_path / "r.json"))).collect()}
    assert rows["1"]["month"] is None and "month is missing" in rows["1"]["faults"]
    assert "month is missing" not in rows["2"]["faults"] and "origin is missing" in rows["2"]["faults"]


def test_models_are_trained_side_by_side_and_failures_reported(spark):
    import threading

    context, meeting = spark.sparkContext, threading.Barrier(2, timeout=60)

    def work(name):
        if name == "bad":
            raise RuntimeError("no such column")
        if name != "late":
            meeting.wait()  # passes only if both run at once
        return context.getLocalProperty(training.POOL), spark.range(10).count()

    done, failures = training.side_by_side(spark, ["a", "bad", "b", "late"], work, 4)
    assert list(done) == ["a", "b", "late"] and done["b"] == ("b", 10)
    assert failures == {"bad": "RuntimeError: no such column"}
    assert context.getLocalProperty(training.POOL) is None
    one, _ = training.side_by_side(spark, ["x", "y"], lambda name: name, 1)
    assert one == {"x": "x", "y": "y"}


def test_a_model_that_fails_leaves_the_others(spark, flights, monkeypatch):
    from ontarmac.operators import features as X, stages

    table, small = X.feature_table(flights, 1999, 2000), stages.ModelSettings(max_iter=2, rf_num_trees=2, rf_max_depth=2)
    everything = {"train_fraction": 1.0, "valid_fraction": 1.0, "test_fraction": 1.0, "settings": small}
    whole = training.compare(table, "lr,rf", **everything)
    classifier = stages.classifier
    monkeypatch.setattr(stages, "classifier", lambda name, s: classifier("none" if name == "rf" else name, s))
    part = training.compare(table, "rf,lr", **everything)
    assert list(part.models) == ["lr"] and "unsupported model" in part.failures["rf"] and part.champion == "lr"
    of_lr = [c.metrics.filter("model_name = 'lr'").orderBy("metric_name").collect() for c in (whole, part)]
    assert [r["metric_name"] for r in of_lr[0]] == [r["metric_name"] for r in of_lr[1]]
    assert all(abs(a["value"] - b["value"]) < 1e-9 for a, b in zip(*of_lr))
    assert part.run["failures"] == part.failures and part.run["sampled_rows"] == whole.run["sampled_rows"]
    monkeypatch.setattr(stages, "classifier", lambda name, s: classifier("none", s))
    with pytest.raises(training.TrainingFailed, match="rf: ValueError"):
        training.compare(table, "rf", **everything)
