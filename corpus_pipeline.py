"""A corpus from raw documents to token ids: five stages, each on what the one before kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import bpe, decontaminate, exact, quality, simhash
from salesmart.llm.common import prepare, shared, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer learned from this stage's own documents accepts."""
    prepare(spark)
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the largest doc_id."""
    prepare(spark)
    return exact.keep_one(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document of the smallest doc_id."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text that they decode to."""
    prepare(spark)
    return bpe.token_digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: SQL can't express the classifier and the tokenizer; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
