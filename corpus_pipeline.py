"""A corpus pipeline over a table of documents: five stages, each written as Parquet and read again by the next.

    documents -> without toxic ones -> one of each near-duplicate group -> without benchmark passages
              -> sources mixed to their target weights -> placed in shards
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runwaylens.llm.common import table
from runwaylens.llm.decontaminate import decontaminate
from runwaylens.llm.mixing import mix
from runwaylens.llm.near_dup import drop_near_duplicates
from runwaylens.llm.sharding import shard
from runwaylens.llm.toxicity import drop_toxic
from runwaylens.sources.scratch import new_folder, stored_at

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score less than 0.7."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked at a similarity of 0.8 or more."""
    return drop_near_duplicates(docs, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of benchmark items; documents that are mostly such windows go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times each."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it."""
    return shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]
# Trained scores, random rounding and label propagation are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = stored_at(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
