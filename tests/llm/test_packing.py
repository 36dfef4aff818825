"""Packing: ids by words against the library, plans, places, and how full sequences are."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ontarmac.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(1)
    parts = ["It's", "ÀÉ", "é", "Σ", "ΑΣ", "\x01", "\x1c", "\x85", " x", "x y", "<|endoftext|>", "日本", "😀", "123", "'s", "--", "́", "İ", "ﬁ"]
    blanks = [" ", "\n", "\t", "\r\n", "\x0b", "\x0c", ""]
    mixed = ["".join(rng.choice(parts) + rng.choice(blanks) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    return ["", " \n", "a " * 9000, *mixed]


def test_ids_by_words_match_whole_texts(tokenizer):
    encoder = packing.WordEncoder(PATH, end_id=1, cached=50)
    texts = odd_texts()
    for start in range(0, len(texts), 7):
        for text, data in zip(texts[start : start + 7], encoder.encode(texts[start : start + 7])):
            ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
            assert np.frombuffer(data, "<u4").tolist() == ids, repr(text)


def test_fullest_matches_all_combinations():
    rng = random.Random(2)
    for _ in range(200):
        counts = {n: rng.randrange(1, 5) for n in rng.sample(range(1, 40), 6)}
        room = rng.randrange(1, 80)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        chosen = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert all(c <= counts[n] for n, c in chosen.items())
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)


def checked(rows, capacity):
    """Sequences without gaps or overlaps, none too long; their number."""
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query_pieces_and_fill(spark, folder, tokenizer):
    from ontarmac.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op8_packing(spark, folder).collect()
    tokens = 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], {})[r["piece"]] = r
    for doc, text in docs.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        tokens += len(ids)
        pieces = by_doc.pop(doc)
        assert len(pieces) == -(-len(ids) // 4096)
        for k, r in pieces.items():
            held = np.array(ids[4096 * k : 4096 * (k + 1)], "<u4")
            assert (r["start"], r["length"], r["ids_crc32"]) == (4096 * k, len(held), zlib.crc32(held.tobytes()))
    assert not by_doc
    assert checked(rows, 4096) <= -(-tokens // 4096) + 1


@pytest.mark.parametrize("pieces_per_salt", [3, 10**6])
def test_hot_length_and_whole_sequences(spark, tokenizer, pieces_per_salt):
    texts = ["one two three"] * 60 + [" ".join(["w"] * n) for n in range(40)] + [None, "", None]
    docs = spark.createDataFrame([(i // 2, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    pieces = packing.token_pieces(docs, PATH, capacity=16, with_ids=True).cache()
    packed = packing.pack(pieces.drop("ids"), 16, pieces_per_salt).cache()
    assert packed.count() == pieces.count() and checked(packed.collect(), 16)
    total = sum(r["length"] for r in packed.collect())
    assert checked(packed.collect(), 16) <= -(-total // 16) + 1


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = spark.createDataFrame([(i, "word " * (i % 13)) for i in range(50)], "doc_id long, text string")
    pieces = packing.token_pieces(docs, PATH, capacity=16, with_ids=True).cache()
    packed = packing.pack(pieces.drop("ids"), 16).cache()
    whole = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in packing.sequences(packed, pieces).collect()}
    for r in packed.collect():
        held = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(held.tobytes()) == r["ids_crc32"]


def test_empty_table_and_null_ids(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    docs = spark.createDataFrame([(None, "a b", None), (1, None, None), (1, None, None)], SCHEMA)
    rows = packing.pack_documents(docs, PATH).collect()
    assert sorted(r["length"] for r in rows) == [1, 1, 3] and checked(rows, 4096) == 1


def test_one_id_on_all_rows_is_numbered_in_many_groups(spark, monkeypatch):
    docs = spark.createDataFrame([(7, "a b c")] * 3000 + [(None, None)] * 200, "doc_id long, text string").repartition(4)
    pieces = packing.cut(packing.token_pieces(docs, PATH).withColumn("row", packing.F.monotonically_increasing_id()))
    numbered = packing._numbered(pieces, {r["length"]: 10 for r in pieces.select("length").distinct().collect()})
    for length in {r["length"] for r in numbered.select("length").distinct().collect()}:
        numbers = sorted(r["number"] for r in numbered.filter(packing.F.col("length") == length).collect())
        assert numbers == list(range(len(numbers)))
    groups = pieces.filter("length > 1").withColumn("salt", packing.F.expr("pmod(xxhash64(row), 10)")).groupBy("salt").count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 500
    checked(packing.pack(pieces).collect(), packing.CAPACITY)


def test_caches_are_emptied_by_bytes_and_kept_per_process():
    encoder = packing.WordEncoder(PATH, cached_bytes=1000)
    for i in range(5):
        encoder.encode([f"{i}" * 700])
    assert len(encoder.known) <= 2
    assert packing._encoder(PATH, 1) is packing._encoder(PATH, 1) is not packing._encoder(PATH, None)
