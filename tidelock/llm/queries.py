"""The queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html, neardup, packing, quality, substring, tokens, toxicity, urlfilter, warc
from .shared import Scratch, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op2"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    folder = f"{scratch.path}/shards"
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("byte_bpe_50k.json"))
    return tokens.read_documents(tokens.write_ids(table(spark, sf_dir, "documents"), vocabulary, 2, folder, scratch), folder)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Rule(words=3, percent=85), Scratch(spark, "op6")).drop("text_hash")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("word_bpe_49k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary, 1, Scratch(spark, "op7"))


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, URL_RULES))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op9")
    folder = f"{scratch.path}/archives"
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), folder, scratch), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), Scratch(spark, "op10")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_html_extraction": op3_html_extraction,
    "op4_token_ids": op4_token_ids,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_packing": op7_packing,
    "op8_url_filters": op8_url_filters,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB SQL for those that SQL can express.
ORACLES: dict[str, str] = {
    "op2_decontaminate": rf"""
        WITH item_words AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), phrases AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS phrase
            FROM item_words, range(1, greatest(len(w) - 9, 1) + 1) r(k) WHERE len(w) > 0
        ), doc_words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), windows AS (
            SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS phrase
            FROM doc_words, (SELECT DISTINCT n FROM phrases) sizes, range(1, len(w) + 1) r(k) WHERE k + n - 1 <= len(w)
        ), found AS (
            SELECT d.doc_id, d.k, d.n, p.item FROM windows d JOIN phrases p ON d.n = p.n AND d.phrase = p.phrase
        ), hits AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM found) x GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) x GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
    """,
    "op6_near_duplicates": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[k:k + 2], ' ') AS s FROM words, range(1, greatest(len(w) - 2, 1) + 1) r(k) WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
        ), both_ways AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT a AS doc_id, b AS root FROM both_ways WHERE b < a UNION SELECT e.a, r.root FROM both_ways e JOIN reached r ON e.b = r.doc_id WHERE r.root < e.a
        )
        SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, w.doc_id) AS component_id, coalesce(r.root, w.doc_id) = w.doc_id AS kept
        FROM words w LEFT JOIN sizes s ON w.doc_id = s.doc_id LEFT JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) r ON w.doc_id = r.doc_id
    """,
    "op9_warc": r"""
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), told AS (
            SELECT page_id, octet_length(encode(payload)) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS response,
                array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (j // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> response THEN response END AS refers_to FROM told
    """,
    "op8_url_filters": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
        ), split AS (
            SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
            FROM parts
        ), rules(verdict, host, path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), fits AS (
            SELECT s.page_id, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC) AS nth
            FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
        )
        SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.nth = 1
    """,
}
