"""Query: license notices in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import table
from runwaylens.llm.licenses import CONTAINED, SHINGLE, TEMPLATES, scan, words
from runwaylens.llm.registry import query


def _shingles(text: str) -> set[str]:
    w = words(text)
    return {" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} or {" ".join(w)}


_ROWS = ", ".join(
    f"('{name}', {len(_shingles(text))}, {len(s.split())}, '{s}')" for name, text in TEMPLATES.items() for s in sorted(_shingles(text))
)
# Containment of every template in every text, by its shingles as text.
SQL = rf"""
WITH t(name, m, k, s) AS (VALUES {_ROWS}), d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(lower(coalesce(text, '')),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), ks AS (SELECT DISTINCT k FROM t), s AS (
  SELECT DISTINCT r, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(i)
), f AS (
  SELECT r, name FROM s JOIN t ON s.k = t.k AND s.s = t.s GROUP BY r, name, m HAVING count(*) >= {CONTAINED} * m - 1e-9
), g AS (SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM f GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(names, '') AS licenses FROM d LEFT JOIN g USING (r)
"""


@query("op8_license_scan", SQL)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"),
    )
