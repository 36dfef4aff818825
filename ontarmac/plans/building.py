"""Building feature tables from curated flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontarmac.operators import features as X, history as H, sampling, summaries, unleaked
from ontarmac.session import own_session
from ontarmac.sources import curated


def flights_for(spark: SparkSession, curated_path: str, dev_subset: bool) -> DataFrame:
    flights = curated.read_curated(spark, curated_path)
    return sampling.dev_subset(X.valid_flights(flights)) if dev_subset else flights


def build_features(
    spark: SparkSession, curated_path: str, output: str, overwrite: bool = False, dev_subset: bool = False
) -> DataFrame:
    """Write the 33-column feature table; returns its rows per split, counted while they are written."""
    seen = summaries.SplitWatch()
    table = X.feature_table(flights_for(own_session(spark), curated_path, dev_subset))
    curated.write_features(table, output, overwrite, watch=seen)
    return summaries.as_split_counts(spark, seen.rows())


def build_history_features(
    spark: SparkSession,
    curated_path: str,
    output: str,
    overwrite: bool = False,
    dev_subset: bool = False,
    rates_path: str | None = None,
    kind: str = "train",
) -> DataFrame:
    """Write the 35-column feature table, of all flights or of the small development subset.

    ``kind`` is the history: rates of the training split as they are, or without a flight's own or later labels
    (:mod:`unleaked`). Where so many rates are joined that the flights are shuffled, these are brought together by month
    before writing. ``rates_path`` keeps the plain rates for scoring, which requests get in either case.
    """
    flights, seen = flights_for(own_session(spark), curated_path, dev_subset), summaries.SplitWatch()
    rates = H.learn_rates(X.derive(flights))
    if rates_path:
        rates.save(rates_path, overwrite)
    plain = kind == "train"
    table = H.history_feature_table(flights, rates=rates) if plain else unleaked.history_feature_table(flights, kind)
    curated.write_features(table, output, overwrite, rates.shuffles() or kind == "as_of", seen)
    return summaries.as_split_counts(spark, seen.rows())
