"""Samples of an exact size."""

import pytest
from pyspark.sql import functions as F

from ontarmac.operators import sampling as S


def drawn(df, sizes, **settings):
    return sorted(tuple(r) for r in S.exact_sample(df, sizes, ["row"], "split", **settings).collect())


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).selectExpr("cast(id as int) row", "if(id % 3 = 0, 'valid', 'train') split", "'v' other").cache()


def plain(df, sizes, seed=42):
    placed = [(*r, i) for i, r in enumerate(df.withColumn("o", S._order(df, ["row"], seed)).orderBy("o").collect())]
    out, seen = [], {}
    for row, split, other, _, _ in placed:
        seen[split] = seen.get(split, 0) + 1
        if seen[split] <= sizes.get(split, 0):
            out.append((row, split, other))
    return sorted(out)


@pytest.mark.parametrize("few", [0, 1, 40, 10_000])
@pytest.mark.parametrize("sizes", [{"train": 7, "valid": 999}, {"train": 2000, "valid": 1001}, {"train": 1, "none": 4}, {"valid": 0}])
def test_the_first_of_an_order_by_hash(rows, sizes, few):
    assert drawn(rows, sizes, few=few) == plain(rows, sizes)


def test_partitioning_changes_nothing_and_seeds_do(rows):
    sizes = {"train": 100, "valid": 50}
    first = drawn(rows, sizes)
    assert drawn(rows.repartition(17).sortWithinPartitions(F.desc("row")), sizes) == first
    assert drawn(rows, sizes, seed=43) != first and len(drawn(rows, sizes, seed=43)) == 150
    smaller = drawn(rows, {"train": 40, "valid": 50})
    assert set(smaller) <= set(first)  # a smaller sample is part of a larger one


def test_rows_alike_in_all_columns(spark):
    alike = spark.range(500).selectExpr("1 row", "'train' split", "'v' other")
    few = spark.range(20).selectExpr("cast(id + 10 as int) row", "'train' split", "'v' other")
    for n in (1, 300, 510, 520, 900):
        got = drawn(alike.union(few), {"train": n}, few=30)
        assert len(got) == min(n, 520) and got == plain(alike.union(few), {"train": n})


def test_nulls_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "train", None), (1, "train", None), (2, None, "x")], "row int, split string, other string")
    assert len(S.exact_sample(df, {"train": 5}, ["row"]).collect()) == 2
    assert S.exact_sample(df.limit(0), {"train": 5}, ["row"]).collect() == []
