"""The audit of filters against a plain count of documents, and the stream that takes its counts back."""

import random
from itertools import permutations

import pytest

from ontarmac.llm import filter_audit as A

SCHEMA = "doc_id long, text string, source string, digest string, n long"
LABELS = "doc_id long, quality int, toxic int"


def plain_fails(rows):
    smallest = {}
    for doc, text, _ in rows:
        if doc is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc), doc)
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = text.encode().split()
        repeated = text in smallest and (doc is None or doc > smallest[text])
        capitals = sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text)
        out.append(
            (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 2 * len(text), any(c in "#$%&*|" for c in text), repeated)
        )
    return out


def plain(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    fails = plain_fails(rows)
    out, shapley = {}, {}
    for order in permutations("ABCDE"):
        for step, letter in enumerate(order, 1):
            k = "ABCDE".index(letter)
            for (doc, _, part), f in zip(rows, fails):
                row = out.setdefault((part or "", "".join(order), step), [0] * 6)
                gone = any(f["ABCDE".index(x)] for x in order[: step - 1])
                removed = f[k] and not gone
                values = (not gone and not f[k], removed, f[k] and gone, f[k] and sum(f) == 1, removed and doc in good, removed and doc in toxic)
                for i, value in enumerate(values):
                    row[i] += bool(value)
                shapley[part or "", letter] = shapley.get((part or "", letter), 0) + bool(removed)
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def table(rng, n):
    words = [f"w{i}" for i in range(400)]
    pool = [" ".join(rng.choice(words[: rng.choice([20, 400])]) for _ in range(rng.randrange(150, 260))) for _ in range(max(1, n // 3))]
    pool = [t.upper() if rng.random() < 0.2 else t + " #" if rng.random() < 0.3 else t for t in pool] + [None, "", "Aa", "é" * 49 + "A"]
    ids = rng.sample(range(10 * n), n)
    rows = [(ids[i], rng.choice(pool), rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(None, pool[0], "a"), (None, "alone", "b"), (None, "alone", None), rows[0], rows[0]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in ids if rng.random() < 0.5]
    return rows, labels + labels[:3] + [(None, 1, 1)]


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def written(spark, rows, path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_counts_are_taken_back_over_micro_batches(spark, tmp_path):
    rows, labels = table(random.Random(3), 60)
    rows.sort(key=lambda r: -(r[0] or 0))  # larger ids come first, so each batch overrules the ones before
    path = f"{tmp_path}/docs"
    for k in range(5):
        written(spark, rows[k * 13 : (k + 1) * 13], path)
    got = A.audit(A.part_counters(spark, path, spark.createDataFrame(labels, LABELS), micro_batches=5))
    assert result(got) == plain(rows[:65], labels)


def test_a_later_call_goes_on_where_the_last_one_ended(spark, tmp_path):
    rows, labels = table(random.Random(4), 40)
    known, path = spark.createDataFrame(labels, LABELS), f"{tmp_path}/docs"
    folders = {"checkpoint": f"{tmp_path}/state", "target": f"{tmp_path}/counts"}
    written(spark, rows[:20], path)
    assert result(A.audit(A.part_counters(spark, path, known, **folders))) == plain(rows[:20], labels)
    written(spark, rows[20:], path)
    for _ in range(2):  # the second time there is nothing new
        assert result(A.audit(A.part_counters(spark, path, known, **folders))) == plain(rows, labels)


def test_empty_table(spark, tmp_path):
    written(spark, [], f"{tmp_path}/docs")
    assert A.audit(A.part_counters(spark, f"{tmp_path}/docs", spark.createDataFrame([], LABELS))).collect() == []


def test_ids_beyond_floats_and_one_id_on_many_rows(spark, tmp_path):
    big = 1 << 60
    rows = [(big + 1, "t", "a"), (big, "t", "a"), (None, "t", "a")] + [(7, f"text {i % 5}", "b") for i in range(200)]
    written(spark, rows, f"{tmp_path}/docs")
    got = A.audit(A.part_counters(spark, f"{tmp_path}/docs", spark.createDataFrame([(7, 1, 0)], LABELS)))
    assert result(got) == plain(rows, [(7, 1, 0)])


def test_ids_must_be_whole_numbers(spark):
    with pytest.raises(TypeError):
        A.masks(spark.createDataFrame([("a", "b", "c")], "doc_id string, text string, source string"))


def test_query_matches_a_plain_count(spark, folder):
    from ontarmac.llm import queries

    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert result(queries.op11_filter_audit(spark, folder)) == plain(rows, labels)
