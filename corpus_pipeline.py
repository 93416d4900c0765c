"""The corpus pipeline: quality, near-duplicates, personal data, mixture,
token ids. Each stage reads what the one before it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airshed.llm import bpe, gam, mixing, pii, simhash
from airshed.llm.common import prepare, table
from airshed.llm.queries import vocabulary
from airshed.session import scratch_path


#: Target shares of tokens, over the domains that the quality stage leaves.
MIXTURE = {"q1t0": 0.97, "q1t1": 0.03}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier scores under 0.3. The
    classifier learns from the labelled rows among ``docs``."""
    prepare(spark)
    return gam.keep_quality(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component (3-word shingles, 3 bits)."""
    prepare(spark)
    return simhash.keep_one_each(docs, shingle=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets."""
    prepare(spark)
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins documents to MIXTURE. Toxic text is thinned to its
    share by soft posteriors, so some clean documents may go with it."""
    prepare(spark)
    return mixing.resample(docs, table(spark, sf_dir, "labels"), MIXTURE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (array<int>) and their number for every remaining row, and
    the SHA-256 of the ids and of the text that they decode to."""
    prepare(spark)
    return bpe.encode_with_digests(docs, vocabulary())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]

#: SQL can't express the trained stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
