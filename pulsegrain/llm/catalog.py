"""Registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pulsegrain.llm import chat, divergence, extract, licenses, mixing, neighbours, packing, pii, quality, simhash, spelling, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted pieces."""
    return chat.digest(chat.format_turns(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back by byte ranges."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model that learned from its labelled rows."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_documents(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of every document and whether its tokeniser fertility is that of its language."""
    return quality.judge(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source of a language differs from the other sources and from the language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the words one edit away."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_warc": op4_warc,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scan": op13_license_scan,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op4_warc": """
        SELECT page_id, payload_bytes, payload_digest, url,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first
              FROM (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                           sha256(coalesce(html, '')) AS payload_digest FROM pages))
    """,
    "op6_mixing": mixing.MIX_SQL,
    "op11_source_divergence": divergence.AUDIT_SQL,
}
