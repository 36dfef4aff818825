"""Mixing: targets, highest quotients, whole results against plain versions."""

import random
import re

import pytest

from ontarmac.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, left = share * sum(sizes.values()), {}, set(names)
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in left}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= over
    return target


def test_query_targets_and_taken_words(spark, folder):
    from ontarmac.llm import queries

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs}
    source = {r["doc_id"]: r["source"] for r in docs}
    sizes = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    target = plain_targets(sizes)
    rows = queries.op5_mixing(spark, folder).collect()
    taken = dict.fromkeys(sizes, 0)
    assert sorted(r["doc_id"] for r in rows) == sorted(size)
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[s]) and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS
    assert sorted(rows) == sorted(queries.op5_mixing(spark, folder).collect())


@pytest.mark.parametrize("blocks", [0, 1, 7, 200, 5000])
def test_seats_are_the_highest_quotients(spark, blocks):
    rng = random.Random(blocks)
    cells = [(f"s{i % 5}", i, rng.choice([5.0, 5.0, rng.random() * 100]), rng.randrange(1, 40)) for i in range(60)] + [(None, 0, 5.0, 3)]
    shards = spark.createDataFrame(cells, "source string, shard long, votes double, limit long")
    quotients = sorted(((-v / (2 * k + 1), s is not None, s or "", c, k) for s, c, v, limit in cells for k in range(limit)))
    wanted = {(s, c): 0 for s, c, _, _ in cells}
    for _, named, s, c, _ in quotients[:blocks]:
        wanted[(s if named else None, c)] += 1
    got = {(r["source"], r["shard"]): r["seats"] for r in mixing.apportion(shards, blocks).collect()}
    assert got == wanted


def test_chosen_blocks():
    for n, seats in ((1, 0), (1, 2), (10, 13), (7, 7)):
        times = mixing.chosen_blocks(n, seats, 5)
        assert times.sum() == seats and times.max() - times.min() <= 1


def test_hot_source_many_shards_and_odd_rows(spark):
    rng = random.Random(0)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", None, "é", "z"]), "w " * rng.randrange(0, 60), "clash") for i in range(900)]
    rows += [(None, None, None, "x"), (5, "hot", "w " * 10, "x"), (5, "hot", "w " * 10, "x"), (7, "empty", "", "x"), (8, "big", "w " * 20_000, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    found = mixing.mix(docs, shard_words=500).collect()
    assert len(found) == len(rows)
    target, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and abs(r["target"] - target[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 16
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    mixed = mixing.mixed(docs, shard_words=500)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
    shards = {s: -(-n // 500) for s, n in sizes.items()}
    for s in sizes:  # whole documents: half of one per shard may be missing or too much
        longest = max((len((t or "").split()) for _, x, t, _ in rows if x == s), default=0)
        assert abs(words.get(s, 0) - target[s]) <= longest * shards[s] + 16
