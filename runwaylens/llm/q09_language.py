"""Query: language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import held_out, table
from runwaylens.llm.language import train_and_identify
from runwaylens.llm.registry import query


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return train_and_identify(docs, ["doc_id"], fixed_order=True).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )
