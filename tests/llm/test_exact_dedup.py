"""Exact dedup: filters, screening against plain grouping, saved snapshots."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontarmac.llm import exact_dedup

SCHEMA = "doc_id long, text string, digest string"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 1000, 30_000])
def test_filters_hold_all_their_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    others = rng.integers(2**63, 2**64, 200_000, dtype=np.uint64)
    held = exact_dedup.build_filter(keys)
    assert exact_dedup.may_contain(keys, *held).all()
    assert exact_dedup.may_contain(others, *held).mean() < 1e-3


def test_groups_match_plain_grouping(spark):
    texts = ["a", "A", "ä", "Ä", "", None, "b c", "B c", "x" * 50_000, "X" * 50_000] * 3 + [f"t{i // 2}" for i in range(60)]
    rows = [(i * 7 % 101, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    wanted = [(i, max(g), len(g), i == max(g), hashlib.sha256(n).hexdigest()) for n, g in groups.items() for i in g]
    for split in (exact_dedup.half_by_id(), F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        assert sorted(map(tuple, exact_dedup.dedup(docs, split).collect())) == sorted(wanted)


def test_screen_lets_all_known_texts_through(spark, tmp_path):
    old = spark.createDataFrame([(i, f"text {i}", None) for i in range(3000)], SCHEMA)
    new = spark.createDataFrame([(i, f"TEXT {i}", None) for i in range(2900, 9000)], SCHEMA)
    rows = exact_dedup.digest_rows(old).withColumn("row", F.monotonically_increasing_id())
    exact_dedup.take_snapshot(rows, keys_per_filter=500).save(str(tmp_path / "s"))
    snapshot = exact_dedup.Snapshot.load(spark, str(tmp_path / "s"))
    assert snapshot.buckets == 6
    batch = exact_dedup.grouped(exact_dedup.digest_rows(new).withColumn("row", F.monotonically_increasing_id()))
    passed = exact_dedup.screen(batch, snapshot)
    known = passed.join(snapshot.groups, "digest", "left_semi").count()
    assert known == 100 and passed.count() < 110


def test_empty_table_repeats_and_null_ids(spark):
    assert exact_dedup.dedup(spark.createDataFrame([], SCHEMA), exact_dedup.half_by_id()).count() == 0
    docs = spark.createDataFrame([(None, "a", None), (5, "A", None), (5, "A", None), (None, "b", None)], SCHEMA)
    rows = exact_dedup.dedup(docs, exact_dedup.half_by_id()).collect()
    got = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows), key=repr)
    assert got == sorted([(None, 5, 3, False), (5, 5, 3, True), (5, 5, 3, False), (None, None, 1, True)], key=repr)
