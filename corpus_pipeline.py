"""The document pipeline: language, near-duplicates, secrets, mix, packed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import langid, mixing, packing, secrets, simhash
from cohortkit.llm.common import staged, table
from cohortkit.llm.queries import public_tokenizer


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.keep_identified(docs, langid.learn(langid.sample_texts(docs)))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.redact_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows."""
    return packing.pack_documents(docs, public_tokenizer())


STAGES = [
    ("language ID", identified), ("SimHash near-dedup", deduplicated), ("secret scans", redacted),
    ("mixing sources to target weights", mixed), ("packing", packed),
]

#: Code lengths, fingerprints and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, "pipeline")
    return docs
