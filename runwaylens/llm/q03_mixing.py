"""Query: how many words the mix takes of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import table
from runwaylens.llm.mixing import mix_plan, per_row
from runwaylens.llm.registry import query


@query("op3_pivotal_mixing")
def op3_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = per_row(mix_plan(docs))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
