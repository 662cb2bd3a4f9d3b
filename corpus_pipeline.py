"""From raw documents to shards: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headrace.llm import decontaminate, forest, mixing, quality, shards
from headrace.llm.tables import Workspace, read_table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return forest.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards their source's weight; a copy is a row like any other."""
    return mixing.mix_sources(docs, copy_column=None)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row; copies of a text lie together where quotas allow."""
    return shards.shard(docs)


STAGES = [("quality_classifier", classify), ("ngram_jaccard_join", deduplicate),
          ("benchmark_decontamination", decontaminated), ("source_mixing", mix), ("sharding", shard)]

# Trained models, sampled hash functions and iterated labels are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs, work = read_table(spark, sf_dir, "documents"), Workspace(spark)
    for _, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir))
    return docs
