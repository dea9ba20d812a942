"""Query: shards of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import size_bytes, table
from runwaylens.llm.registry import query
from runwaylens.llm.sharding import shard


@query("op10_label_propagation_shards")
def op10_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = (size_bytes(F.col("text")) + 16).alias("size")
    placed = shard(docs.select("doc_id", size, F.crc32("text").alias("text_crc32"), "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
