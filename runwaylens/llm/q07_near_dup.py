"""Query: near-duplicate groups of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import table
from runwaylens.llm.near_dup import group_near_duplicates
from runwaylens.llm.registry import query


@query("op7_minhash_near_dup")
def op7_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = group_near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return groups.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
