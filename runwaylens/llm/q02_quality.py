"""Query: quality statistics and verdicts of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runwaylens.llm.common import table
from runwaylens.llm.quality import judge
from runwaylens.llm.registry import query


@query("op2_quality_outliers")
def op2_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"
    )
