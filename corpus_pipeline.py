"""The corpus pipeline: stages applied one after the other to `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lawgrain.llm import decontaminate, packing, pii, quality, simhash
from lawgrain.session import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("vector_packing", packing_stage),
]

# No statement: the last stage packs the ids of a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
