"""All text queries; importing the parts fills the registry."""

from __future__ import annotations

import corpus_pipeline
from runwaylens.llm import (  # noqa: F401
    q01_tokens,
    q02_quality,
    q03_mixing,
    q04_decontaminate,
    q05_toxicity,
    q06_reputation,
    q07_near_dup,
    q08_licenses,
    q09_language,
    q10_sharding,
    q11_bpe,
    q12_merkle,
    q13_shallot,
)
from runwaylens.llm.registry import QUERIES, SQL  # noqa: F401

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
