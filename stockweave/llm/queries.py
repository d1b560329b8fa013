"""The registered queries of this package over the given tables, and their SQL where SQL can say the same."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import (
    codes,
    licenses,
    mixing,
    oracles,
    pieces,
    quality,
    resampling,
    secret_scan,
    simhash,
    substrings,
    topk,
    toxicity,
    url_filter,
    warc,
)
from stockweave.llm.common import numbered, text_of, tuned
from stockweave.session import settle_table
from stockweave.sources.tables import load_table

URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
# hosts with one of these labels are on the block list
BLOCKED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def blocked_hosts(pages: DataFrame) -> DataFrame:
    """The hosts of `pages` that have a blocked label."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in BLOCKED_LABELS])))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(load_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def toxic_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learned from the labelled documents that are not held out."""
    docs, labels = load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels")
    return toxicity.learn(toxicity.training_rows(docs, labels.filter(~toxicity.held_out())))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxic_lexicon(spark, sf_dir))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "n_hits")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, URL_RULES, blocked_hosts(pages))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(load_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.span_digest(base), 256).alias("base_sha256"),
        secret_scan.span_digest(F.col("spans")).alias("spans"),
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(text_of()).alias("size"))
    mixed = mixing.mix(numbered(sized, "row_id", "mix-documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(load_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "distance")


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a replica that lacks some records and has a changed byte in some others."""
    pages = load_table(spark, sf_dir, "pages")
    html = F.coalesce("html", F.lit(""))
    damaged = F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("?"), F.substr(html, F.lit(2)))).otherwise(html)
    lost = F.coalesce(F.col("page_id") % 193 == 7, F.lit(False))
    sound = warc.record(F.col("url"), html)
    records = pages.select(
        "page_id",
        F.octet_length(sound).cast("long").alias("length"),
        F.sha2(sound, 256).alias("digest"),
        F.sha2(warc.record(F.col("url"), damaged), 256).alias("replica_digest"),
        lost.alias("lost"),
    )
    placed = settle_table(warc.lay_out(records, ["page_id", "digest"]), "warc-index")
    replica = placed.filter(~F.col("lost")).select("file", "offset", "length", F.col("replica_digest").alias("digest"))
    found = warc.audit(placed.select("file", "offset", "length", "digest"), replica)
    named = placed.select("file", "offset", "page_id")
    return found.join(named, ["file", "offset"]).select("page_id", "file", "offset", "length", "fault")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# the vocabulary file: a parameter, never part of the repository
PIECES_MODEL = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(load_table(spark, sf_dir, "documents"), pieces.load_model(PIECES_MODEL))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(load_table(spark, sf_dir, "documents")).drop("spans")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, wanted = load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, wanted).select("doc_id", "n_features", "weight", "score", "rank")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(load_table(spark, sf_dir, "embeddings"))
    found = codes.with_label_error(coded)
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    return found.select("vec_id", codes.code_text(F.col("code")).alias("code"), "error", "label_error", digest)


def _tuned(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(tuned(spark), sf_dir)

    return run


QUERIES = {
    q.__name__: _tuned(q)
    for q in (
        op1_substring_dedup,
        op2_toxicity,
        op3_url_filter,
        op4_secret_scan,
        op5_mix_sources,
        op6_simhash,
        op7_quality,
        op8_warc_fixity,
        op9_top_k,
        op10_pieces,
        op11_license_scan,
        op12_importance_resampling,
        op13_vector_codes,
    )
}

ORACLE = {
    "op3_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        ruled AS (
            SELECT *,
                   CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills',
                                                                'free-bets', 'spam-farm']) THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM ruled""",
    "op8_warc_fixity": r"""
        WITH records AS (
            SELECT page_id, html,
                   octet_length(encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                       || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                       || 'Content-Type: text/html' || chr(13) || chr(10)
                       || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10)
                       || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10))) AS length
            FROM pages),
        placed AS (SELECT *, (row_number() OVER (ORDER BY page_id) - 1) // 1000 AS file FROM records),
        offsets AS (
            SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
            FROM placed)
        SELECT page_id, file, "offset", length,
               CASE WHEN page_id % 193 = 7 THEN 'missing' ELSE 'changed' END AS fault
        FROM offsets
        WHERE page_id % 193 = 7
           OR (page_id % 97 = 13 AND coalesce(html, '') <> '?' || substring(coalesce(html, ''), 2))""",
    "op9_top_k": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
            FROM embeddings),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return ORACLE | oracles.ORACLE
