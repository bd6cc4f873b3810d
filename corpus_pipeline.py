"""Documents to training shards: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clipwell.llm import decontamination, line_quality, mixing, near_copies, sharding
from clipwell.llm.common import checkpoint_folder, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are not depleted of lines their host does not repeat."""
    return line_quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash, or five-word shingles at a similarity of 0.8), the one with the smallest id."""
    return near_copies.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.sharded(docs, 24)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: SQL cannot express fingerprints and spaced seeds; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored in the session's shared folder."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
