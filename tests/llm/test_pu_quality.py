"""Quality classifier: prior, held-out accuracy, folds and odd rows."""

import zlib

import numpy as np

from pyspark.sql import functions as F

from ontarmac.llm import pu_quality


def drawn(rng, good, n):
    return rng.normal(1.0 if good else -1.0, 0.5, (n, 4))


def test_prior_and_boundary_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    for share in (0.85, 0.5):
        n = 6000
        truth = rng.random(n) < share
        mixed = np.where(truth[:, None], drawn(rng, True, n), drawn(rng, False, n))
        net, prior = pu_quality.fit(drawn(rng, True, 2000), mixed)
        assert abs(prior - share) < 0.08
        assert ((net.score(mixed) >= 0.5) == truth).mean() > 0.97


def test_risk_gradient_matches_differences():
    rng = np.random.default_rng(1)
    p, u, prior, step = rng.normal(0, 1, 5), rng.normal(0.5, 1, 7), 0.3, 1e-6

    def risk(p, u):
        return prior * np.logaddexp(0, -p).mean() + np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()

    slope = np.concatenate(pu_quality.nn_slope(prior)(p, u))
    both = np.concatenate([p, u])
    for i in range(len(both)):
        up = both.copy()
        up[i] += step
        assert abs((risk(up[:5], up[5:]) - risk(p, u)) / step - slope[i]) < 1e-4


def test_query_agrees_with_held_out_labels(spark):
    from ontarmac.llm import queries

    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op6_quality_classifier(spark, folder).collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for doc, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(rows[d]["predicted"], q) for d, q in labels.items() if rows[d]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_labels_of_the_held_out_fold_do_not_matter(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    open_only = labels.filter(pu_quality.fold("doc_id") != pu_quality.HELD_OUT)
    assert sorted(pu_quality.classify(docs, labels).collect()) == sorted(pu_quality.classify(docs, open_only).collect())


def test_empty_tables_null_ids_and_no_labels(spark):
    schema = "doc_id long, text string, score string"
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert pu_quality.classify(spark.createDataFrame([], schema), none).count() == 0
    docs = spark.createDataFrame([(None, None, "clash"), (3, "a b", "x"), (3, "a b", "x"), (4, "", None)], schema)
    rows = pu_quality.classify(docs, none).collect()
    assert sorted((r["id"] or 0, r["score"], r["predicted"]) for r in rows) == [(0, 0.5, 1), (3, 0.5, 1), (3, 0.5, 1), (4, 0.5, 1)]
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    assert pu_quality.keep_good(docs, labels).columns == docs.columns


def test_one_id_on_many_rows_keeps_the_bounds(spark, monkeypatch):
    rows = [(2, f"word {i} of some text") for i in range(5000)] + [(i, f"text {i}") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (10, 1), (11, 1)], "doc_id long, quality int")
    held = {}
    monkeypatch.setattr(pu_quality, "fit", lambda good, rest: held.update(rows=len(good) + len(rest)))
    pu_quality.train(docs, labels, max_positive=5, max_unlabelled=5)
    assert 0 < held["rows"] <= 10


def test_lowest_is_the_whole_order_cut_off(spark):
    rows = spark.range(5000)
    for n in (0, 7, 1200, 2500, 6000):
        got = {r["id"] for r in pu_quality.common.lowest(rows, n, "id").collect()}
        assert got == {r["id"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(n).collect()}
