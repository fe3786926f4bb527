"""From raw documents to token ids: five stages, each one operator of ``billstream.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billstream.llm import byte_bpe, decontaminate, language_crf, pii, simhash
from billstream.llm.common import stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_crf.known_language(docs)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_groups(docs)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(docs, byte_bpe.ranks_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", keep_first_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_documents),
    ("pii", redact_personal_data),
    ("byte_bpe", encode_bytes),
]

#: SQL can express neither the learned language model nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
