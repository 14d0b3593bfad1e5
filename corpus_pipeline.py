"""A training-data pipeline: quality rules, near-duplicates, personal data, mixing, tokens.

Each stage takes the documents that the one before kept, as Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from laddermill.llm import bpe, mixing, near_dedup, pii, quality
from laddermill.llm.common import shared_dir, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id. Shingles here have five words."""
    return near_dedup.drop_near_duplicates(docs, shingle=5)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with tags in the place of personal data."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document of a source with several epochs appears several times."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the decoded text of each document of the mix."""
    return bpe.tokenize(docs)


STAGES = [("quality rules", keep_good), ("near-duplicates", drop_near_duplicates), ("personal data", redact), ("mixing", mix), ("tokens", tokenize)]

#: Expectation-maximisation, near-duplicates and BPE are not expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
