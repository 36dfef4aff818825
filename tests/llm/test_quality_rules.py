"""Quality rules: counts against plain definitions, trees against labels, monotonic scores."""

import re

import numpy as np

from ontarmac.llm import quality_rules, text_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", "a b c a b c", "x x x x", "é\x85ü w a\nb\n\n b\nb\n", "#*$%&|<> #\n#\n # \n#", "p q r s\np q r s\n" * 40]


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_counts_of_odd_texts():
    for text in TEXTS:
        assert text_stats.measure(text or "")[0] == plain_counts(text or "")


def test_query_counts_match_plain_ones(spark, folder):
    from ontarmac.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op1_quality_rules(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts = plain_counts(docs[r["doc_id"]] or "")
        assert list(r[1:6]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["kept"] and r["base_failed"])


def test_flattened_trees_learn_and_respect_directions():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = (0.8 - x[:, 0] + 0.6 * np.sin(6 * x[:, 1]) + rng.normal(0, 0.2, 4000) > 0.3).astype(float)
    trees = quality_rules.fit(x, y, np.array([True, False, False]))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9
    grid = np.linspace(-1, 2, 200)
    for other in rng.random((50, 2)):
        line = np.column_stack([grid, np.tile(other, (200, 1))])
        assert (np.diff(trees.score(line)) <= 1e-12).all()


def test_kept_documents_follow_the_labels(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    good = [" ".join(rng.choice(words, 80)) + ".\nmore text here." for _ in range(150)]
    bad = [" ".join(w + "%%%" for w in rng.choice(words, 80)) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(good + bad)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 250, 2)] + [(None, 1), (1, None)], "doc_id long, quality int")
    kept = {r["id"]: r["kept"] for r in quality_rules.judge(docs, labels).collect()}
    assert kept == {i: i < 150 for i in range(250)}


def test_empty_tables_null_ids_and_no_labels(spark):
    schema, labelled = "doc_id long, text string", "doc_id long, quality int"
    none = spark.createDataFrame([], labelled)
    assert quality_rules.judge(spark.createDataFrame([], schema), none).count() == 0
    docs = spark.createDataFrame([(None, None), (2, " ".join(map(str, range(60)))), (2, " ".join(map(str, range(60))))], schema)
    rows = quality_rules.judge(docs, none).collect()
    assert sorted((r["id"] or 0, r["kept"]) for r in rows) == [(0, False), (2, True), (2, True)]
