"""Token counts: chunks spliced at stable boundaries against whole encodings."""

import random

import public_tokenizers
import pytest
import sentencepiece

from ontarmac.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_tokens string"


def odd_texts():
    rng = random.Random(3)
    words = ["the", "tion", "été", "straße", "日本語", "😀", "<s>", "▁", "</s>", "a" * 40, "  ", "\n", "\t", "%%%", "x́"]
    mixed = [" ".join(rng.choice(words) for _ in range(n)) for n in (5, 300, 900)]
    return [None, "", " ", "a" * 3000, "ab" * 900, " " * 2500, "日" * 1500, "😀" * 700, "\x00" * 50, "<0x41>" * 300, *mixed, "".join(mixed)]


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (500, 40)])
def test_counts_match_whole_encodings(spark, chunk, overlap):
    texts = odd_texts() * 2
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    rows = token_counts.count_tokens(docs, PATH, huge_bytes=200, chunk=chunk, overlap=overlap).collect()
    whole = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert {r["id"]: r["n_tokens"] for r in rows} == {i: len(whole.encode(t or "")) for i, t in enumerate(texts)}
    assert {r["id"]: r["n_bytes"] for r in rows} == {i: len((t or "").encode()) for i, t in enumerate(texts)}


def test_query_matches_the_library(spark, folder):
    from ontarmac.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    whole = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in queries.op3_token_counts(spark, folder).collect():
        n = len(whole.encode(docs.pop(r["doc_id"])))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 4096)
    assert not docs


def test_empty_table_and_null_ids(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    docs = spark.createDataFrame([(None, "a b", None), (1, "x " * 300, None), (1, "x " * 300, None)], SCHEMA)
    rows = token_counts.count_tokens(docs, PATH, huge_bytes=100, chunk=50, overlap=8).collect()
    assert sorted((r["id"] or 0, r["n_bytes"]) for r in rows) == [(0, 3), (1, 600), (1, 600)]
