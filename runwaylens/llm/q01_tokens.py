"""Query: tokens of every document under a unigram tokenizer."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from runwaylens.llm.common import table
from runwaylens.llm.registry import query
from runwaylens.llm.tokens import with_token_counts

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/piece_bpe_32k.model")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, VOCABULARY).select("doc_id", "n_tokens")
