"""Periodic runs against a search of all periods."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from ontarmac.llm import period_runs as P


def plain_runs(words):
    """Start, length and period of all runs."""
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    spans = set()
    for q in range(1, len(ids) // 3 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        change = np.flatnonzero(same[1:] != same[:-1])
        spans |= {(int(a), int(b) + q, q) for a, b in zip(change[::2], change[1::2]) if b + q - a >= max(24, 3 * q)}
    smallest = [s for s in spans if not any(p < s[2] and a <= s[0] and b >= s[1] for a, b, p in spans)]
    return sorted(((a, b - a, q) for a, b, q in smallest), key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def random_words(rng):
    kinds = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(kinds) for _ in range(rng.randrange(250))]
    for _ in range(rng.randrange(3)):
        at, period = rng.randrange(len(words) + 1), rng.randrange(1, 12)
        words[at:at] = ([rng.randrange(kinds + 1) for _ in range(period)] * 30)[: rng.randrange(10, 200)]
    if rng.random() < 0.3:  # passages that come again, so that symbols are derived in several places
        words = words + words[: rng.randrange(len(words) + 1)] + words
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_the_search(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        for words, row in zip(texts, P._results(texts)):
            assert [(r["start"], r["length"], r["period"]) for r in row[0]] == plain_runs(words)


def test_grammar_gives_the_words_back():
    rng = random.Random(9)
    for _ in range(30):
        ids = P._numbered([random_words(rng), random_words(rng)])
        if not len(ids):
            continue
        grammar = P.repair(ids)
        symbols = grammar.rest.tolist()
        pairs = [p for p in zip(symbols, symbols[1:]) if p[0] != p[1]]
        assert len(pairs) == len(set(pairs))  # no pair is left twice
        while any(s >= grammar.first for s in symbols):
            symbols = [p for s in symbols for p in ((s,) if s < grammar.first else (grammar.left[s - grammar.first], grammar.right[s - grammar.first]))]
        assert symbols == ids.tolist()


def test_hashes_that_agree_by_chance_change_nothing(monkeypatch):
    monkeypatch.setattr(P.Words, "_equal", lambda self, a, b, size: np.ones(len(a), bool))
    for words in ([b"a", b"b"] * 20 + [b"c"] + [b"a", b"b"] * 20, [b"x"] * 30 + [b"y"] * 30):
        found = [(r["start"], r["length"], r["period"]) for r in P._results([words])[0][0]]
        assert set(found) <= set(plain_runs(words))


ODD = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "A a " * 30, "x\x0by\x0c" * 12, "ä ö " * 20 + "ü", "w " * 100_000, "b c d " * 7 + "b c d e"]


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a b " * 40), (3, "a b " * 40), (None, "a b " * 40)]
    docs = spark.createDataFrame([(*r, "z", "z") for r in rows], "doc_id long, text string, runs string, name string")
    found = P.find_runs(docs, with_text=True).collect()
    assert len(found) == len(rows)
    expected = sorted(repr((i, *plain_row((t or "").encode().split()))) for i, t in rows if len(t or "") < 10_000)
    got = sorted(
        repr((r["id"], len(r["runs"]), r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"]))
        for r in found
        if r["length"] != 100_000
    )
    assert got == expected
    long = next(r for r in found if r["length"] == 100_000)
    assert (long["start"], long["period"], long["collapsed"]) == (0, 1, "w")
    assert P.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_matches_the_search(spark, folder):
    from ontarmac.llm import queries

    expected = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words, h = (r["text"] or "").encode().split(), crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        expected[r["doc_id"]] = plain_row(words)
    got = {r[0]: tuple(r)[1:] for r in queries.op12_period_runs(spark, folder).collect()}
    assert got == expected
