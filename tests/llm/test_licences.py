"""Licence scans: notices, near misses and unknown ones, windows, odd rows."""

import random

import numpy as np
import pytest

from ontarmac.llm import licences

PLAIN = [f"the {a} of {b} and {c} was on the way to {d}." for a in ("cat", "sea") for b in ("rain", "snow") for c in ("wind", "ice") for d in ("town", "land")]


@pytest.fixture(scope="module")
def model():
    return licences.train([x.encode() for x in PLAIN])


def families(model, text):
    return [n["family"] for n in licences.judge_text(model, text)]


def test_templates_are_found_in_texts(model):
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            whole = f"{PLAIN[0]}\n{text}\n{PLAIN[1]}"
            (notice,) = licences.judge_text(model, whole)
            assert notice["family"] == family and whole[notice["start"] : notice["stop"]] == text


def test_varied_copies(model):
    rng = random.Random(9)
    for family, texts in licences.TEMPLATES.items():
        words = max(texts, key=len).split()
        if len(words) > 12:
            words[rng.randrange(len(words))] = "changed"
            assert families(model, " ".join(words).upper() + "!!") == [family]


def test_unknown_and_no_notices(model):
    assert families(model, "Licensed under the terms of the Zed Community License, version 2.") == ["unknown"]
    for text in [*PLAIN, *licences.NEAR_MISSES, "mit", "Ungte mit.", "the license", "", " \n\t\n"]:
        assert families(model, text) == []


def test_notice_within_a_long_line(model):
    filler = " ".join(PLAIN * 10)
    text = filler + " " + licences.TEMPLATES["apache"][1] + " " + filler
    assert families(model, text) == ["apache"]


def test_scores_match_dense_features(model):
    units = [licences.words_of(t.encode()) for ts in licences.TEMPLATES.values() for t in ts] + [[b"the"], [b"zzz"]]
    dense = licences._features(model, units) @ model.weights + model.bias
    assert np.abs(model.logits(units) - dense).max() < 1e-4


def test_query_finds_exactly_the_planted_lines(spark):
    from ontarmac.llm import queries

    folder = "/root/testdata/sf0.01"
    lines = {
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "All rights reserved.": "reserved",
    }
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    wanted = {d["doc_id"]: sorted({lines[x] for x in d["text"].split("\n") if x in lines}) for d in docs}
    got = {r["doc_id"]: r["families"].split(",") if r["families"] else [] for r in queries.op2_licences(spark, folder).collect()}
    assert got == wanted


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string, notices string"
    assert licences.scan(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "Released under the MIT License.", "x"), (1, None, None), (1, None, None)], schema)
    assert sorted(len(r["notices"]) for r in licences.scan(docs).collect()) == [0, 0, 1]


def test_families_of_a_one_line_text(model):
    filler = " ".join(PLAIN * 15)
    parts = [filler, "Permission — « é » .", licences.TEMPLATES["mit"][1], filler, licences.TEMPLATES["gpl"][0], filler, "All rights reserved.", filler]
    text = " ".join(parts)
    found = licences.judge_text(model, text)
    assert [n["family"] for n in found] == ["mit", "gpl", "reserved"]
    for notice, wanted in zip(found, (parts[2], parts[4], parts[6])):
        a, b = notice["start"], notice["stop"]
        at = text.index(wanted)
        assert a < at + len(wanted) and at < b and b - a < 1200
        assert text[a : b + 1].strip() == text[a:b] and (a == 0 or text[a - 1] == " ")


def test_short_notices_amid_long_filler(model):
    for family, notice in (("mit", "Released under the MIT License."), ("bsd", "Released under the BSD License."), ("reserved", "All rights reserved.")):
        for before in range(0, 60, 7):
            words = " ".join(PLAIN * 15).split()
            text = " ".join([*words[: 100 + before], notice, *words[:200]])
            (found,) = licences.judge_text(model, text)
            assert found["family"] == family
            assert found["start"] <= text.index(notice) and text.index(notice) + len(notice) <= found["stop"]


def test_a_family_twice_in_a_line_is_two_notices(model):
    filler = " ".join(PLAIN * 15)
    text = f"{filler} Released under the MIT License. {filler} Released under the MIT License. {filler}"
    assert families(model, text) == ["mit", "mit"]


def test_background_is_drawn_from_whole_texts(spark):
    far = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, f"first line\n\n{far}\nlast line")] + [(2, f"line {i}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = licences.background_lines(docs.filter("doc_id = 1"), "doc_id", "text", 300, 10_000)
    words = [w for line in lines for w in line.split() if w.startswith(b"w")]
    assert sorted(words) == sorted(far.encode().split()) and {b"first line", b"last line"} <= set(lines)
    assert max(len(line.split()) for line in lines) <= licences.WINDOW_WORDS
    assert len(licences.background_lines(docs, "doc_id", "text", 300, 50)) == 50
    assert len(licences.background_lines(docs.filter("doc_id = 2"), "doc_id", "text", 7, 50)) == 7  # rows, whatever their ids
    assert licences.background_lines(docs.limit(0), "doc_id", "text", 300, 50) == []
