"""From documents to packed sequences: five stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm import mixing, packing, pii, simhash, toxicity
from pulsegrain.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones, does not reject.

    A null or empty text is scored like any other; repeated rows are judged alike, so all of them stay
    or go; other columns pass through; an empty table gives no rows.
    """
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest doc_id.

    Texts without words, null ones too, are one group. Of rows that repeat a doc_id the one with the smallest hash of its
    values stays; rows without a doc_id all stay; other columns pass through; an empty table gives no rows.
    """
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text.

    A null text stays null, with a null n_chars, and an empty one empty; repeated rows are redacted alike; of spans that
    overlap the first one counts; other columns pass through; an empty table gives no rows.
    """
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own, the last; a text without words has size 0 and is taken by its place in the
    seeded order; rows that repeat a doc_id share a place, so they are taken alike; all columns of a row are repeated; an
    empty table gives no rows.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 4096 tokens.

    A null text is empty, which is one piece of the end token; repeated rows are placed each for itself; only doc_id and
    text are read; an empty table gives no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Models, fingerprints and vocabularies have no SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written to the shared folder and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
