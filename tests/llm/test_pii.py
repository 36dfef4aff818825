"""Personal data: base spans against plain patterns, the label model, added spans, odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from ontarmac.llm import pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and plain_luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(PHONE, text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_spans_of_random_texts():
    rng = random.Random(5)
    parts = ["a@b.c", "@", "x.y%+-_", "4111 1111 1111 1111", "1.2.3.4", "+", "(0", "é", "٣", "4", "00", "255", "256", ".", "-", " ", "12", "@d.e", "b@"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_end_soon():
    for text in ("1" * 100_000, "1." * 50_000, "a@" * 50_000, "+1" * 50_000, "a" * 100_000 + "@", "Dr. " * 20_000, "12-34 " * 15_000):
        base = pii.base_spans(text)
        pii.candidates(text, base)


def test_label_model_finds_reliabilities():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.6
    right = np.array([0.95, 0.8, 0.6])
    cast = np.where(rng.random((20_000, 3)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    cast[rng.random((20_000, 3)) < 0.2] = 0
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    _, found, share = pii.label_model(patterns, counts.astype(float))
    assert np.abs(found - right).max() < 0.06 and abs(share - 0.6) < 0.06


GOOD = [
    ("iban", "pay to my account DE89 3704 0044 0532 0130 00 please", "DE89 3704 0044 0532 0130 00"),
    ("email", "write to jane.doe at mail dot org today", "jane.doe at mail dot org"),
    ("ssn", "my social security number 123-45-6789 is", "123-45-6789"),
    ("phone", "please call (030) 1234 56789 now", "(030) 1234 56789"),
    ("person", "a letter from Dr. Anna Schmidt came", "Anna Schmidt"),
]
CLEAN = ["plain words only.", "version 123-45 of page 12", "prices 10.000 and 20.000,50", "order 000-00-0000 there", "", None]


def test_added_spans_and_clean_texts(spark):
    texts = [t for _, t, _ in GOOD] * 20 + CLEAN * 20
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = pii.detect(docs)
    rows = {r["id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in found.collect()}
    for i, text in enumerate(texts):
        if i < 20 * len(GOOD):
            kind, _, value = GOOD[i % len(GOOD)]
            at = text.index(value)
            assert rows[i] == [(kind, at, at + len(value))]
        else:
            assert rows[i] == []
    hidden = {r["id"]: r["text"] for r in pii.masked(docs).collect()}
    assert hidden[2] == "my social security number <ssn> is" and hidden[len(texts) - 1] is None


def test_masking_tells_rows_apart_that_share_an_id(spark):
    rows = [(1, "mail a@b.org now"), (1, "nothing at all here to see"), (None, "ip 1.2.3.4"), (None, "plain"), (1, None), (2, "mail a@b.org now"), (1, "mail a@b.org now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["id"], r["text"]) for r in pii.masked(docs).collect()), key=repr)
    hidden = {"mail a@b.org now": "mail <email> now", "ip 1.2.3.4": "ip <ip>"}
    assert got == sorted(((i, hidden.get(t, t)) for i, t in rows), key=repr)


def test_query_matches_plain_base_spans(spark, folder):
    from ontarmac.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op9_pii(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert pii.detect(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "a@b.de"), (1, "+49 30 1234567"), (1, "+49 30 1234567")], schema)
    assert sorted(len(r["spans"]) for r in pii.detect(docs).collect()) == [1, 1, 1]


def test_query_trains_on_base_spans_and_failed_matches(spark, monkeypatch):
    from ontarmac.llm import queries

    seen, train = [], pii.train
    monkeypatch.setattr(pii, "train", lambda counted: seen.append(counted) or train(counted))
    folder = "/root/testdata/sf0.01"
    queries.op9_pii(spark, folder)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted = Counter(k for t in texts for k, _, _ in plain_base(t))
    by_rule = Counter()
    for r in seen[0]:
        by_rule[r["kind"]] += r["n"] * (r["votes"][pii.LABELERS.index("base rules")] > 0)
    assert +by_rule == wanted and sum(wanted.values()) > 0
    assert set(train(seen[0])) >= set(wanted)


def test_failed_matches_vote_and_are_not_added(spark):
    good = ["card 4111 1111 1111 1111 there", "host 10.1.2.3 there", "call +49 30 1234567 now", "mail a.b@example.org now"]
    bad = ["number 4111 1111 1111 1112 there", "release 300.1.2.3 there", "item 8812345 of many", "at +12.3 degrees"]
    docs = spark.createDataFrame(list(enumerate((good + bad) * 20)), "doc_id int, text string")
    counted = pii.vote_counts(pii.found_spans(docs))
    rule = pii.LABELERS.index("base rules")
    assert sorted((r["kind"], r["votes"][rule], r["n"]) for r in counted if r["votes"][rule] < 0) == [
        ("card", -1, 20), ("ip", -1, 20), ("phone", -1, 20), ("phone", -1, 20)
    ]
    for r in pii.detect(docs).collect():
        assert r["spans"] == r["base"] and len(r["spans"]) == (r["id"] % 8 < 4)
