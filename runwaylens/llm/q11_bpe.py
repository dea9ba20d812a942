"""Query: byte pair encoding and decoding of every document."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.bpe import decode, encode
from runwaylens.llm.common import table
from runwaylens.llm.registry import query

VOCABULARY = os.environ.get("BPE_FILE", "/opt/tokenizers/byte_bpe_50k.json")


@query("op11_bpe_automaton")
def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, VOCABULARY, packed=True).select("doc_id", "ids")
    return decode(ids, VOCABULARY).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
