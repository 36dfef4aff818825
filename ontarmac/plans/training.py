"""Training, comparing and exporting classifiers."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from ontarmac import constants as K
from ontarmac.operators import evaluation as E, features as X, leaderboard as L, sampling, scoring, stages, summaries
from ontarmac.session import freeing_shuffles, own_session, scratch_job, scratch_path
from ontarmac.sources import curated


log = logging.getLogger(__name__)
POOL = "spark.scheduler.pool"
ROWS_PER_TASK = 500_000  # some 350 MB once a forest holds them
HELD_ROWS = 2_000_000  # some 4 GB once a forest of 80 trees holds them with their places


class TrainingFailed(RuntimeError):
    """No model of a comparison could be trained."""


@dataclass(frozen=True)
class Comparison:
    """Trained models with their metrics; ``metrics`` is long, ``board`` has one ranked row per model.

    ``failures`` has the message of each model that could not be trained or measured; such models are on no board. ``run`` is
    the record of the run: what was asked for, and the rows each sample had.
    """

    models: dict[str, PipelineModel]
    metrics: DataFrame
    board: DataFrame
    sampled_rows: dict[str, int]
    previews: dict[str, DataFrame] = field(default_factory=dict)
    numeric: list[str] = field(default_factory=lambda: list(K.NUMERIC_COLUMNS))
    categorical: list[str] = field(default_factory=lambda: list(K.CATEGORICAL_COLUMNS))
    failures: dict[str, str] = field(default_factory=dict)
    run: dict = field(default_factory=dict)

    @property
    def champion(self) -> str:
        return L.champion(self.board)


def side_by_side(spark: SparkSession, names: list[str], work: Callable[[str], object], at_once: int) -> tuple[dict, dict[str, str]]:
    """What ``work`` gives for each name, in the order of the names, and the messages of those it failed for.

    Up to ``at_once`` run at a time, each in a scheduler pool of its own name, so that under fair scheduling (``spark.scheduler.mode``)
    short jobs of one do not wait for long stages of another. Threads get the job properties and tags of their caller.
    """
    context = spark.sparkContext

    def pooled(name: str):
        before = context.getLocalProperty(POOL)
        context.setLocalProperty(POOL, name)
        try:
            return work(name)
        finally:
            context.setLocalProperty(POOL, before)

    done, failures = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as threads:
        waiting = {name: threads.submit(inheritable_thread_target(spark)(pooled), name) for name in names}
        for name, result in waiting.items():
            try:
                done[name] = result.result()
            except Exception as problem:  # one model's failure leaves the others
                failures[name] = f"{type(problem).__name__}: {problem}"
                log.warning("%s could not be trained", name, exc_info=problem)
    return done, failures


def spread(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` in parts of about ``rows_per_task`` where some part has more; else as they are.

    Vectors are much larger than the Parquet they come from, so what one task reads of a file is too much to train on. The rows are dealt
    to scratch files, one per part, which take less than the shuffle that deals them; it is dropped at once.
    """
    parts = rows.groupBy(F.spark_partition_id().alias("part")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    if (parts["most"] or 0) <= rows_per_task:
        return rows
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())  # deals any rows evenly, equal ones too
    path, files = scratch_path(rows.sparkSession, "dealt"), own_session(rows.sparkSession)
    with freeing_shuffles(rows.sparkSession):
        numbered.repartition(-(-parts["all"] // rows_per_task), "_row").drop("_row").write.parquet(path)
    files.conf.set("spark.sql.files.openCostInBytes", "1g")  # no file is read together with another
    return files.read.schema(rows.schema).parquet(path)


def fits_at_once(rows: int, at_once: int) -> int:
    """How many models are fitted side by side on so many training rows.

    Each fit holds copies of the rows in its own form and drops them at its end. Beyond ``HELD_ROWS`` several fits' copies would spill
    together, while one fit has tasks enough for all cores.
    """
    return at_once if rows <= HELD_ROWS else 1


def compare(
    features: DataFrame,
    models: str = "lr,rf",
    primary_metric: str = "valid_pr_auc",
    min_year: int | None = None,
    max_year: int | None = None,
    train_fraction: float = 0.01,
    valid_fraction: float = 0.05,
    test_fraction: float = 0.05,
    settings: stages.ModelSettings = stages.ModelSettings(),
    numeric: list[str] = K.NUMERIC_COLUMNS,
    categorical: list[str] = K.CATEGORICAL_COLUMNS,
    preview_rows: int = 10,
    at_once: int = 3,
) -> Comparison:
    """Train each model on the train sample and measure it on the valid and test samples.

    Index, one-hot and assembly are fitted once and shared; only the classifiers differ. Both evaluation
    samples are scored in one pass per model. Models are trained side by side, ``at_once`` at a time, or one after the other where the
    rows are many; one that fails is reported, and only if all fail this is an error.
    """
    names = stages.model_names(models)
    L.selection_metric(primary_metric)
    window = X.year_window(features, min_year, max_year)
    sampled = sampling.split_samples(window, train_fraction, valid_fraction, test_fraction, settings.seed)

    encoder = Pipeline(stages=stages.feature_stages(categorical, numeric)).fit(sampled["train"])
    kept = ["features", K.LABEL]
    spark = features.sparkSession
    with scratch_job(spark):
        dealt = spread(sampled["train"].select(*numeric, *categorical, K.LABEL))
        train = encoder.transform(dealt).select(*kept).persist(StorageLevel.DISK_ONLY)
        shown = [c for c in ("split", "carrier", "origin", "dest") if c not in kept]
        held_out = (
            encoder.transform(sampled["valid"].unionByName(sampled["test"]))
            .select(*kept, *shown)
            .persist(StorageLevel.DISK_ONLY)
        )
        try:
            counted = {r["split"]: r["count"] for r in summaries.split_counts(held_out).collect()}
            rows = {"train": train.count()} | {s: counted.get(s, 0) for s in ("valid", "test")}
            # a handful of rows, the same for each model; only these are scored a second time
            few = scoring.preview_rows(X.of_split(held_out, "valid"), preview_rows)
            few = spark.createDataFrame(few.collect(), few.schema)

            def trained(name: str) -> tuple[PipelineModel, list, DataFrame]:
                model = stages.lean(stages.classifier(name, settings), rows["train"] > HELD_ROWS).fit(train)
                predictions = model.transform(held_out)
                with scratch_job(spark):
                    metrics = E.as_long(E.evaluate(predictions, ["split"], E.class_score()), ["split"])
                    # ten numbers per model
                    measured = [(name, *r) for r in metrics.select("split", "metric", "value", "metric_name").collect()]
                return stages.assembled(encoder, model), measured, scoring.preview(model.transform(few), preview_rows)

            done, failures = side_by_side(spark, names, trained, fits_at_once(rows["train"], at_once))
        finally:
            train.unpersist()
            held_out.unpersist()
    if not done:
        raise TrainingFailed("; ".join(f"{name}: {message}" for name, message in failures.items()))
    measured = [row for _, rows_of, _ in done.values() for row in rows_of]
    metrics = spark.createDataFrame(
        measured, "model_name string, split string, metric string, value double, metric_name string"
    )
    board = L.leaderboard(metrics, list(done), primary_metric)
    run = {
        "models": names, "primary_metric": primary_metric, "min_year": min_year, "max_year": max_year,
        "fractions": {"train": train_fraction, "valid": valid_fraction, "test": test_fraction},
        "settings": {name: float(value) for name, value in asdict(settings).items()},
        "sampled_rows": rows, "failures": failures,
    }
    return Comparison(
        {name: model for name, (model, _, _) in done.items()}, metrics, board, rows,
        {name: shown for name, (_, _, shown) in done.items()}, list(numeric), list(categorical), failures, run,
    )


RUN_SCHEMA = (
    "models array<string>, primary_metric string, min_year int, max_year int, fractions map<string, double>, settings map<string, double>,"
    " sampled_rows map<string, long>, failures map<string, string>"
)


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    """Save a model; an existing path is an error unless it is to be replaced."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def export_champion(comparison: Comparison, path: str, overwrite: bool = False) -> str:
    save_model(comparison.models[comparison.champion], path, overwrite)
    return comparison.champion


def write_reports(comparison: Comparison, folder: str, overwrite: bool = False) -> None:
    """Leaderboard, feature schema, prediction previews and the record of the run as JSON."""
    spark = comparison.metrics.sparkSession
    schema = spark.createDataFrame(
        [(comparison.categorical, comparison.numeric, list(comparison.models))],
        "categorical_cols array<string>, numeric_cols array<string>, selected_models array<string>",
    )
    curated.write_report(comparison.board, f"{folder}/leaderboard", overwrite)
    curated.write_report(schema, f"{folder}/feature_schema", overwrite)
    curated.write_report(spark.createDataFrame([comparison.run], RUN_SCHEMA), f"{folder}/run", overwrite)
    for name, rows in comparison.previews.items():
        curated.write_report(rows, f"{folder}/{name}_valid_predictions", overwrite)


class ModelShelf:
    """Saved models by id, each loaded when first asked for."""

    def __init__(self, paths: dict[str, str], default: str):
        if default not in paths:
            raise ValueError(f"unknown default model: {default}")
        self.paths = paths
        self.default = default
        self._loaded: dict[str, PipelineModel] = {}

    def get(self, model_id: str | None = None) -> PipelineModel:
        key = (model_id or "").strip().lower() or self.default
        if key not in self.paths:
            raise ValueError(f"Unsupported model_id: {key}")
        if key not in self._loaded:
            self._loaded[key] = PipelineModel.load(self.paths[key])
        return self._loaded[key]

    def all(self) -> dict[str, PipelineModel]:
        return {key: self.get(key) for key in self.paths}
