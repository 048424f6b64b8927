"""Registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import convtrie, decontaminate, language, mixing, neardup, secrets, spelling, suffixes, tokenfiles, tokens, topk, toxicity, warc
from inkwell.llm.common import table
from inkwell.plans import catalog


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_query(table(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats_query(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk_query(table(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_query(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_query(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_query(table(spark, sf_dir, "documents"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.neardup_query(table(spark, sf_dir, "documents"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokens_query(table(spark, sf_dir, "documents"))


def op11_convtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.convtrie_query(table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_query(table(spark, sf_dir, "documents"))


def chunk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered here, as every query of the catalog has an SQL twin and this one has none."""
    return catalog.token_chunks(spark, sf_dir)


def op13_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.tokenfiles_query(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_suffixes, op3_topk, op4_decontaminate, op5_secrets, op6_warc, op7_toxicity, op8_mixing, op9_neardup, op10_tokens,
        op11_convtrie, op12_spelling, op13_tokenfiles, chunk_tokens,
    )
}

ORACLES = {
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
        d AS (
            SELECT page_id, octet_length(encode(payload)) AS payload_bytes, hex,
                   list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
                   min(page_id) OVER (PARTITION BY hex) AS first
            FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM d
    """,
}
