"""SimHash: fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from ontarmac.llm import simhash


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=3):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return {doc: min(g) for g in groups.values() for doc in g}


TEXTS = [None, "", " \t\n", "One", "one two", "one two three", "ONE two three four", "ÄB äb c d", "x " * 3000, "y\x0bz\x0cw v"]


def test_fingerprints_of_odd_texts():
    for text in TEXTS:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_close_pairs_match_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = base[rng.integers(0, 5, 700)]
    for _ in range(4):
        flip = rng.random(700) < 0.5
        fps = np.where(flip, fps ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)), fps)
    n = len(fps)
    first, last = np.arange(1, n + 1), np.full(n, n)
    found = {(a, b) for i, j in simhash.close_pairs(fps, first, last, radius) for a, b in zip(i.tolist(), j.tolist())}
    values = fps.tolist()
    assert found == {(i, j) for i in range(n) for j in range(i + 1, n) if (values[i] ^ values[j]).bit_count() <= radius}


def near_texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(400)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(400)] = rng.choice(words)
            out.append(" ".join(copy))
    return out + TEXTS * 2


@pytest.mark.parametrize("block_rows", [4, 1 << 15])
def test_components_match_brute_force(spark, block_rows):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    got = {r["id"]: r["component_id"] for r in simhash.near_dedup(docs, block_rows=block_rows).collect()}
    rows = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    assert got == plain_components(rows)


@pytest.mark.parametrize("count", [10, 1 << 24, 1 << 33])
def test_every_block_plan_finds_the_same_links(spark, count):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64).tolist()
    near = [x ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for x in base for a, b, c in rng.integers(0, 64, (3, 3))]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in base + near})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r["vertex"]: r["root"] for r in simhash.components(simhash.links(fps, count)).collect()}
    rows = [(v, v & (2**64 - 1)) for v in values]
    assert {v: roots.get(v, v) for v in values} == plain_components(rows)


def test_chain_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 99), (101, 99)], "u long, v long")
    got = {r["vertex"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 99, 101: 99}


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert simhash.near_dedup(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "a b c"), (4, "A B C"), (4, "a b c"), (None, "other words here")], schema)
    got = sorted(((r["id"], r["component_id"]) for r in simhash.near_dedup(docs).collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None)], key=repr)
    docs = spark.createDataFrame([(None, "other words here"), (4, "a b c"), (4, "a b c"), (7, "A B C")], schema)
    assert sorted((r["doc_id"] or 0 for r in simhash.survivors(docs).collect())) == [0, 4]
