"""The pipeline against plain versions of its stages, and tables with odd rows."""

from collections import Counter

import corpus_pipeline
from ontarmac.llm import exact_dedup, mixing, packing, simhash
from tests.llm.test_packing import checked
from tests.llm.test_simhash import plain_components, plain_fingerprint

STAGES = dict(corpus_pipeline.STAGES)


def lower(text):
    return text.encode().lower()


def test_stages_on_whole_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources"):
        before = docs.collect()
        docs = STAGES[name](spark, docs, folder).cache()
        after = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert set(after) <= set(before) and after
        kept = {r["doc_id"] for r in after}
        if name == "exact dedup":
            assert kept == set({lower(r["text"]): r["doc_id"] for r in sorted(before)}.values())
        if name == "SimHash near-dedup":
            rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in before]
            assert kept == set(plain_components(rows).values())
        if name == "mixing sources":
            taken = {r["id"]: r for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect()}
            copies = Counter(r["doc_id"] for r in after)
            assert all(copies[i] == int(r["taken"] / max(r["size"], 1) + 0.5) for i, r in taken.items())
    pieces = STAGES["best-fit packing"](spark, docs, folder).collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())
    checked(pieces, packing.CAPACITY)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, fp string"
    rows = [
        (None, None, None, None, None, "x", "y", "z"),
        (1, "", "en", "a", 0, None, None, None),
        (2, "word " * 300, "en", "a", 1500, None, None, None),
        (2, "word " * 300, "en", "a", 1500, None, None, None),
        (3, "WORD " * 300, None, None, None, "x", "y", "z"),
        (4, "some other words that stand here", "en", "b", 32, "x", "y", "z"),
    ]
    spark.createDataFrame([(2, 1, 0), (4, 1, None), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path)).cache()
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            docs.count()
        assert corpus_pipeline.packed(spark, docs, str(tmp_path)).count() >= 0


def test_repeated_rows_count_once(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "c d"), (None, "e"), (None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["text"] for r in exact_dedup.survivors(docs).collect()) == ["a b", "c d", "e"]


def test_rows_that_share_an_id_only_are_told_apart(spark):
    rows = [(None, "e"), (9, "e"), (None, "f"), (None, "G h"), (None, "g H"), (5, "f g"), (5, "f"), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in exact_dedup.survivors(docs).collect())
    assert got == [(0, "G h"), (5, ""), (5, "f"), (5, "f g"), (9, "e")]
    rows = [(None, "e"), (9, "E"), (None, "f"), (None, "G h"), (None, "g H"), (5, "f g"), (5, "E"), (5, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"] or 0, r["text"].lower()) for r in simhash.survivors(docs).collect()]
    assert sorted(kept) == [(0, "g h"), (5, "e"), (5, "f"), (5, "f g")]
