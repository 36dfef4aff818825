"""The corpus pipeline: stages over whole documents, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before has kept. The first three drop documents,
the fourth repeats or drops them to reach the sources' targets, the last cuts and packs their tokens into sequences. All but
the last return the columns of ``docs``. Ids may be null and rows may repeat; what each stage makes of them is
stated with its operator. An empty table goes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ontarmac.llm import exact_dedup, mixing, packing, pu_quality, simhash
from ontarmac.session import cut


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from the labels and the documents at hand."""
    return pu_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id."""
    return exact_dedup.survivors(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of close fingerprints join the one with the smallest id."""
    return simhash.survivors(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document's tokens with the sequence it is in and its place there."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources", source_mix),
    ("best-fit packing", packed),
]
ORACLE_SQL = None  # hashes, a trained model and seeded choices; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each result written below the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
