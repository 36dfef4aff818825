"""The corpus operators as registered queries over the test tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ontarmac.llm import (
    exact_dedup, filter_audit, licences, mixing, ngram_join, packing, period_runs, pii, pu_quality, quality_rules, simhash, token_counts, warc,
)

TOKEN_LIMIT = 4096


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(_table(spark, folder, "documents"))
    notices = F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"], n["stop"]))
    return found.select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"]))), ",").alias("families"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(notices, ",").alias("notices"),
    )


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = token_counts.count_tokens(_table(spark, folder, "documents"), path)
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_dedup(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = pu_quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = exact_dedup.dedup(docs, exact_dedup.half_by_id())
    return found.withColumnRenamed("id", "doc_id")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumnRenamed("id", "doc_id")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(_table(spark, folder, "documents"))

    def of_kind(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in pii.BASE_KINDS]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.joined(F.array_sort("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    target = warc.archive_folder(spark)
    files = warc.write_archives(_table(spark, folder, "pages"), target)
    records = warc.read_archives(files, target, with_payload=False)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(filter_audit.part_counters(spark, f"{folder}/documents.parquet", _table(spark, folder, "labels")))


def op12_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = period_runs.find_runs(_table(spark, folder, "documents"), change=period_runs.looped)
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    )


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.similar(_table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_licences, op3_token_counts, op4_simhash, op5_mixing, op6_quality_classifier, op7_exact_dedup, op8_packing, op9_pii, op10_warc, op11_filter_audit, op12_period_runs, op13_ngram_join)}

ORACLES = {
    "op7_exact_dedup": """
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        ), groups AS (
            SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY body
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM normal JOIN groups USING (body)
    """,
    "op10_warc": """
        WITH digests AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
        ), bits AS (
            SELECT *, array_to_string(list_transform(
                range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')), '') AS bits
            FROM digests
        ), coded AS (
            SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32),
                lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST('0b' || bits[5 * i + 1 : 5 * i + 5] AS INTEGER)]), '') AS payload_digest
            FROM bits
        ), firsts AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM coded
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response_id THEN response_id END AS refers_to
        FROM firsts
    """,
    "op11_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), marked AS (
            SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
                100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) AS c,
                regexp_matches(body, '[#$%&*|]') AS d,
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e
            FROM words
        ), labelled AS (
            SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
                coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, count(*) AS n
            FROM marked LEFT JOIN (
                SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
            ) USING (doc_id)
            GROUP BY ALL
        ), letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
            FROM letters v JOIN letters w ON w.f <> v.f JOIN letters x ON x.f NOT IN (v.f, w.f)
            JOIN letters y ON y.f NOT IN (v.f, w.f, x.f) JOIN letters z ON z.f NOT IN (v.f, w.f, x.f, y.f)
        ), steps AS (
            SELECT filter_order, step::INT AS step, bits[step] AS own,
                coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
            FROM orders, range(1, 6) r(step)
        ), counted AS (
            SELECT part, filter_order, step, own,
                sum(CASE WHEN mask & own = 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
                sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
                sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
                sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n * bad ELSE 0 END)::BIGINT AS toxic_lost
            FROM labelled CROSS JOIN steps GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM counted
    """,
    "op13_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 80 * (p.n + q.n - c)
        ), reach(x, y) AS (
            SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
        )
        SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.least_id, d.doc_id)) AS component_id,
            coalesce(l.n, 0)::BIGINT AS n_links
        FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
        LEFT JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) r ON d.doc_id = r.x
        LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) l ON d.doc_id = l.x
    """,
}
