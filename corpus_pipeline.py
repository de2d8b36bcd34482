"""A corpus cleaned and packed: quality rules, language, near copies, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import decontam, language, packing, rules, simhash
from storelens.llm.tables import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a proven cutoff rejects go."""
    return rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language.known_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return simhash.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of token sequences. Executors that have done the other stages have less memory left for pieces."""
    return packing.pack(docs, remembered=400_000)


STAGES = [
    ("quality rules", quality_rules),
    ("language", language_id),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packed_sequences),
]

#: Language models, proven cutoffs and token ids have no SQL form; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the whole table of documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
