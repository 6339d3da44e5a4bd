"""The corpus pipeline: good documents, one of each group of near copies, no benchmark passages, no personal data, ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller writes as Parquet and reads again as the
next stage's documents. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termloom.llm import bpe, decontaminate, pii, quality, simhash
from termloom.llm.shared import stored

#: SQL expresses neither the classifier nor the merges; tests compare the stages with plain versions.
ORACLE_SQL = None
LEAST_SCORE = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.3 or more, learned from the labelled ones among them."""
    found = stored(quality.with_statistics(docs), "statistics")
    return quality.keep_good(docs, quality.learn(found, spark.read.parquet(f"{sf_dir}/labels.parquet")), LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints that link at 4 differing bits or fewer: the least doc_id."""
    return simhash.drop_near_copies(docs, width=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is 0.8 or more similar to a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced in their texts."""
    return pii.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their byte-level BPE ids (`ids`, little-endian unsigned 32-bit) and `n_tokens`."""
    return bpe.with_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("byte_bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
