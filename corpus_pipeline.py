"""The training-data pipeline over `documents`: filters, duplicate removal, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkveil.llm import dart_minhash, decontaminate, packing, suffix_dedup, toxicity
from inkveil.session import staged

#: Passages of over 50 words that an earlier document has: 51 words of one byte, with a byte between two, have 101 bytes.
PASSAGES = suffix_dedup.SuffixParams(min_bytes=101, anchor_bytes=32, splits=(18, 4, 1), min_words=51, folded=True, across=True)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go; it learns from `labels`."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of least id stays."""
    return dart_minhash.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that an earlier document has are cut out of the texts."""
    return suffix_dedup.remove_later(docs, PASSAGES)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", civil),
    ("minhash_near_dedup", distinct),
    ("suffix_array_dedup", passages),
    ("benchmark_decontamination", unseen),
    ("best_fit_packing", sequences),
]

#: The stages learn models and compare texts pair by pair, which SQL cannot express; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written as a table and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
