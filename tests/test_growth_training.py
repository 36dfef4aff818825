"""Training rows are dealt over enough tasks."""

import time

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from ontarmac import constants as K, session
from ontarmac.checks import model_queries
from ontarmac.operators import stages
from ontarmac.plans import training
from ontarmac.session import FREED, freeing_shuffles


def test_parts_of_training_rows_are_bounded(spark):
    one = spark.range(1000, numPartitions=1).selectExpr("cast(id % 2 as int) v")
    parts = [r["n"] for r in training.spread(one, 100).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) == 10 and sum(parts) == 1000 and max(parts) < 200  # equal rows are dealt out too
    assert training.spread(one, 1000) is one
    assert training.spread(one.filter("v > 5"), 10).count() == 0


def flown(spark):
    """Model columns, label and split of 120 flights, each there twice."""
    numbers = [((F.col("id") * (7 + i)) % 23).cast("double").alias(c) for i, c in enumerate(K.NUMERIC_COLUMNS)]
    words = [F.concat(F.lit(c), (F.col("id") % (2 + i)).cast("string")).alias(c) for i, c in enumerate(K.CATEGORICAL_COLUMNS)]
    late = ((F.col("id") * 7 % 23 > 11) | (F.col("id") % 5 == 0)).cast("int").alias(K.LABEL)
    return spark.range(240, numPartitions=2).select((F.col("id") % 120).alias("id")).select(*numbers, *words, late, F.lit("train").alias("split"))


def test_forests_keep_places_and_stay_the_same(spark):
    settings = stages.ModelSettings(rf_num_trees=4, rf_max_depth=4)
    rows = Pipeline(stages=stages.feature_stages()).fit(flown(spark)).transform(flown(spark)).cache()
    ours = stages.classifier("rf", settings)
    plain = RandomForestClassifier(numTrees=4, maxDepth=4, seed=42, labelCol=K.LABEL)
    assert ours.getCacheNodeIds() and ours.getCheckpointInterval() == -1
    said = [f.fit(rows).toDebugString.split("\n", 1)[1] for f in (ours, plain)]  # the first line has the model's own id
    assert said[0] == said[1] and "If" in said[0]


def test_flights_are_told_three_ways_without_joins(spark):
    for name in ("gbt", "lr"):
        settings = stages.ModelSettings(max_iter=3, gbt_max_iter=2, gbt_max_depth=2)
        model = stages.pipeline(name, settings).fit(flown(spark))
        told = model_queries.told_three_ways(flown(spark), model, model)
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        rows = told.collect()
        assert len(rows) == 240 and len({r["p"] for r in rows}) > 1
        assert all(r["p"] == r["loaded_p"] and abs(r["p"] - r["table_probability"]) < 1e-9 and (r["class"] == 1) == (r["p"] > 0.5) for r in rows)


def in_splits(spark):
    return flown(spark).withColumn("split", F.expr("case when month % 4 = 0 then 'valid' when month % 4 = 1 then 'test' else 'train' end"))


def test_dealt_rows_are_files_and_leave_nothing(spark, tmp_path, monkeypatch):
    one = spark.range(1000, numPartitions=1).selectExpr("cast(id % 2 as int) v", "cast(id as string) w")
    dealt = training.spread(one, 100)
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.exceptAll(one).isEmpty() and one.exceptAll(dealt).isEmpty() and dealt.dtypes == one.dtypes
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(training, "spread", lambda rows, deal=training.spread: deal(rows, 50))
    everything = {"train_fraction": 1.0, "valid_fraction": 1.0, "test_fraction": 1.0}
    rows = training.compare(in_splits(spark), "lr", settings=stages.ModelSettings(max_iter=2), **everything).sampled_rows
    assert sum(rows.values()) == 240 and not list(tmp_path.iterdir())


def test_many_rows_are_fitted_one_model_at_a_time_without_places(spark, monkeypatch):
    settings = stages.ModelSettings(max_iter=2, rf_num_trees=4, rf_max_depth=4)
    table, everything = in_splits(spark), {"train_fraction": 1.0, "valid_fraction": 1.0, "test_fraction": 1.0, "settings": settings}
    asked, places, whole, lean = [], [], training.side_by_side, stages.lean
    monkeypatch.setattr(training, "side_by_side", lambda s, n, w, at_once: asked.append(at_once) or whole(s, n, w, at_once))

    def seen(estimator, many_rows):
        made = lean(estimator, many_rows)
        places.extend([made.getCacheNodeIds()] if isinstance(made, RandomForestClassifier) else [])
        return made

    monkeypatch.setattr(stages, "lean", seen)
    few = training.compare(table, "lr,rf", **everything)
    monkeypatch.setattr(training, "HELD_ROWS", 10)
    many = training.compare(table, "lr,rf", **everything)
    assert asked == [3, 1] and places == [True, False]
    said = [c.models["rf"].stages[-1].toDebugString.split("\n", 1)[1] for c in (few, many)]  # the first line has the model's own id
    assert said[0] == said[1] and "If" in said[0]


def test_writes_drop_their_shuffle_files(spark, tmp_path):
    def held():
        store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {block.toString() for block in (store.getAllBlocks().apply(i) for i in range(store.getAllBlocks().size())) if block.isShuffle()}

    before, was = held(), spark.conf.get(FREED, None)
    with freeing_shuffles(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "freed"))
    deadline = time.time() + 10
    while held() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not held() - before and spark.conf.get(FREED, None) == was
    spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "kept"))
    assert held() - before
