"""Dictionaries of values against the indexer that holds them on the driver."""

import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ontarmac.operators import dictionaries as D


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    values = ["a"] * 300 + [f"v{rng.randrange(200)}" for _ in range(700)] + ["é", "Z", "", " "] + [None] * 40
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row int, c string").repartition(5).cache()


@pytest.mark.parametrize("most", [1000, 0])
@pytest.mark.parametrize("per_part", [7, 1 << 20])
def test_indexes_are_those_of_the_indexer(spark, rows, per_part, most, tmp_path):
    learned = rows.filter("row % 10 < 8")
    D.learn(learned, "c", per_part).save(str(tmp_path / "d"))
    dictionary = D.Dictionary.load(spark, str(tmp_path / "d"))
    ours = {r["row"]: r["i"] for r in dictionary.index(rows, "i", max_broadcast_rows=most).collect()}
    indexer = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(learned)
    theirs = {r["row"]: int(r["i"]) for r in indexer.transform(rows).collect()}
    assert ours == theirs and dictionary.size == len(indexer.labels)


def test_a_column_of_a_million_values(spark):
    df = spark.range(1_200_000).selectExpr("concat('v', lpad(cast(id % 1000000 as string), 7, '0')) c", "id row")
    dictionary = D.learn(df, "c", 100_000)
    assert (dictionary.size, dictionary.rows) == (1_000_000, 1_200_000)
    parts = dictionary.table.agg(F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(parts) == (1_000_000, 0, 999_999)
    # twice each: the first 200,000 in order, then the others
    assert dictionary.table.filter("index <> cast(substring(value, 2) as long)").isEmpty()
    assert dictionary.index(df, max_broadcast_rows=1000).filter("c_idx <> row % 1000000").isEmpty()


def test_no_values(spark, rows):
    dictionary = D.learn(rows.filter("c is null"), "c")
    assert (dictionary.size, dictionary.rows) == (0, 0)
    assert {r["c_idx"] for r in dictionary.index(rows).collect()} == {0}
    assert dictionary.index(rows.limit(0)).collect() == []


def test_several_columns(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "q")], "a string, b string")
    got = D.index_all(df, D.learn_all(df, ["a", "b"])).collect()
    assert sorted((r["a_idx"], r["b_idx"]) for r in got) == [(0, 0), (0, 1), (1, 0)]
