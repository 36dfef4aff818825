"""Scoring requests as they arrive: each run scores the files that have come since the last.

A micro-batch is scored as a table is (:func:`serving.score_requests`). What it accepts goes to ``scored/batch=N`` and what it rejects, with
the faults, to ``rejected/batch=N`` below the output folder, to be looked at and sent again. A batch that is repeated after a failure
writes its own two folders anew, so nothing is lost or doubled; readers of either table see the number of the batch as a column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ontarmac.operators import scoring
from ontarmac.operators.history import DelayRates
from ontarmac.plans import serving
from ontarmac.session import cut, scratch_job

TABLES = ["scored", "rejected"]


def deliver(
    output: str, models: Mapping[str, PipelineModel], default: str, rates: DelayRates | None = None
) -> Callable[[DataFrame, int], None]:
    """What is done with a micro-batch: its two folders are written, in place of what an earlier attempt has left."""

    def write(batch: DataFrame, number: int) -> None:
        with scratch_job(batch.sparkSession):
            held = cut(batch)  # the files are read and parsed once
            for name, rows in zip(TABLES, serving.score_requests(held, models, default, rates)):
                rows.write.mode("overwrite").parquet(f"{output.rstrip('/')}/{name}/batch={number}")

    return write


def score_arrivals(
    spark: SparkSession,
    requests: str,
    output: str,
    checkpoint: str,
    models: Mapping[str, PipelineModel],
    default: str,
    rates: DelayRates | None = None,
    files_at_once: int = 1000,
) -> None:
    """Score all request files (JSON lines) not seen by earlier runs, then stop.

    The checkpoint remembers which files were taken. A field that is absent or of the wrong type is NULL and so a fault.
    """
    stream = spark.readStream.schema(scoring.REQUEST_SCHEMA).option("maxFilesPerTrigger", files_at_once).json(requests)
    query = (
        stream.writeStream.foreachBatch(deliver(output, models, default, rates))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_delivered(spark: SparkSession, output: str, table: str = "scored") -> DataFrame:
    """All batches of a table so far."""
    if table not in TABLES:
        raise ValueError(f"unknown table: {table}; choose from {', '.join(TABLES)}")
    return spark.read.parquet(f"{output.rstrip('/')}/{table}")
