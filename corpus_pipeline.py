"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept: documents without a recognised language go,
one document of each group of near copies stays, secrets are masked, sources are mixed to their
targets (documents repeat or go), and what remains is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantwatch.llm import jaccard, languages, mixture, packing, secret_scan
from plantwatch.llm.common import read_table, saved, small_batches

#: Bytes of words that a worker keeps in the last stage, and of texts it encodes at once: its executor's heap is full by then.
KEPT_BYTES = 16 << 20
ENCODE_BYTES = 1 << 20


def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return languages.accepted(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.one_per_group(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, kept_bytes=KEPT_BYTES, encode_bytes=ENCODE_BYTES)


STAGES = [
    ("language_id", keep_recognised),
    ("near_duplicates", keep_one_of_near_copies),
    ("secrets", mask_secrets),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the profiles, the tokenizer or best fit; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
