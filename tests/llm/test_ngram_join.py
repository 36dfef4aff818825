"""N-gram Jaccard join against all pairs of sets."""

import random

import numpy as np
import pytest

from ontarmac.llm import ngram_join as J


def plain_set(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(rows, percent=80, size=5):
    """Component and number of links per row."""
    sets = [plain_set(t, size) for _, t in rows]
    root, count = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
                count[i] += 1
                count[j] += 1
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc), doc)
    return [(doc, len(sets[i]), smallest.get(find(i)) if sets[i] else doc, count[i]) for i, (doc, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r])


def texts(seed, n=260):
    """Near copies of few bases with shared passages, so that many pairs are near the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    bases = [[rng.choice(words) for _ in range(rng.randrange(20, 140))] for _ in range(6)]
    out = [None, "", " \t\n", "One", "one", "one two", "a b c d e", "A b c D e", "a b c d e f", "x " * 4000]
    while len(out) < n:
        copy = list(rng.choice(bases))
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        if rng.random() < 0.3:  # a passage in a third of all texts
            copy += passage
        if rng.random() < 0.2:
            copy = copy[: rng.randrange(len(copy))]
        out.append(" ".join(copy).title() if rng.random() < 0.1 else " ".join(copy))
    return out


SETTINGS = [{}, {"shingles_per_part": 50, "block_docs": 16}, {"block_shingles": 300}, {"percent": 60, "size": 3}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_matches_all_pairs(spark, settings):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts(len(settings)))]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, v string")
    found = J.similar(docs, **settings)
    assert found.columns == ["id", "n_shingles", "component_id", "n_links"]
    got = [tuple(r) for r in found.collect()]
    assert ordered(got) == ordered(plain(rows, settings.get("percent", 80), settings.get("size", 5)))


def test_exactly_the_percentage_links(spark):
    words = [f"w{i}" for i in range(13)]  # 9 shingles, 8 of 10 with one word more at one end and less at the other
    rows = [(1, " ".join(words)), (2, " ".join(words[1:] + ["z"])), (3, " ".join(words[2:] + ["z", "y"]))]
    rows += [(i, t) for i, t in ((10, "a b c d e f g h"), (11, "a b c d e f g h i"), (12, "b c d e f g h i"))]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert ordered(tuple(r) for r in J.similar(docs).collect()) == ordered(plain(rows))


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (5, "A b c d e f"), (5, "a b c d e f"), (None, "other words"), (5, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(tuple(r) for r in J.similar(docs).collect()) == ordered(plain(rows))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.similar(empty).collect() == []


def test_hot_copies_and_one_shingle_in_a_third_of_the_texts(spark):
    rng = random.Random(5)
    own = [" ".join(str(rng.random()) for _ in range(20)) for _ in range(200)]
    rows = [(i, "the same five words here " + t if i % 3 == 0 else t) for i, t in enumerate(own)]
    rows += [(1000 + i, "one text that many rows have in common") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(tuple(r) for r in J.similar(docs, block_docs=8).collect()) == ordered(plain(rows))


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_linkable_sizes_share_a_class(percent):
    bounds = J.size_bounds(percent, 5000)
    sizes = np.arange(1, 3000)
    own = np.searchsorted(bounds, sizes, side="right")
    widest = own[np.minimum(sizes * 100 // percent, 2999) - 1]
    assert (widest - own <= 1).all()


@pytest.mark.parametrize("percent", [20, 33, 50, 80, 95])
def test_linked_sets_meet_in_the_screen(percent):
    rng = random.Random(percent)
    for _ in range(3000):
        n = rng.randrange(1, 40)
        common, a, b = (rng.randrange(n + 1) for _ in range(3))
        pool = rng.sample(range(1000), common + a + b)
        x, y = sorted(pool[: common + a]), sorted(pool[:common] + pool[common + a :])
        if common and 100 * common >= percent * len(pool):
            sent = [set(s[: J.screened(len(s), percent)]) for s in (x, y)]
            assert len(sent[0] & sent[1]) >= max(1, max(len(x), len(y)) * J.SCREEN_PERCENT // 100)


def test_query_matches_all_pairs(spark, folder):
    from ontarmac.llm import queries

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op13_ngram_join(spark, folder).collect()]
    assert ordered(got) == ordered(plain(rows))
