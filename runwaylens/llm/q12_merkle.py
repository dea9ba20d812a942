"""Query: Merkle manifest of all documents, with tampered rows found by their proofs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import table
from runwaylens.llm.merkle import fold, leaf_digest, manifest, proof_digest
from runwaylens.llm.registry import query

LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf(**changed: Column) -> Column:
    return leaf_digest(*[changed.get(c, F.col(c)) for c in LEAF_FIELDS])


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar))::varchar || ':' || {value}::varchar, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if c == "n_chars" else c) for c in LEAF_FIELDS) + ")"


SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS total, {_sql_leaf("n_chars")} AS leaf,
    -- crc32, bit by bit over the decimal digits
    xor(list_reduce(flatten(list_concat([[4294967295]], list_transform(string_split(doc_id::varchar, ''),
      lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT *, CASE WHEN crc % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} ELSE leaf END AS given FROM numbered),
nodes AS (
  SELECT 0 AS lvl, lang, pos AS i, leaf AS d, total AS c FROM leaves
  UNION ALL
  SELECT lvl + 1, lang, i // 2, sha256(string_agg(d, '' ORDER BY i)), (c + 1) // 2
  FROM nodes WHERE c > 1 GROUP BY lvl, lang, i // 2, c),
subroots AS (
  SELECT lang, d AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS total FROM nodes WHERE c = 1),
tops AS (
  SELECT 0 AS lvl, pos AS i, subroot AS d, total AS c FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (c + 1) // 2 FROM tops WHERE c > 1 GROUP BY lvl, i // 2, c),
steps AS (
  SELECT l.lang, l.pos, x.lvl AS step, ((l.pos >> x.lvl) & 1) = 1 AS is_left, s.d
  FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
  JOIN range(0, 64) x(lvl) ON x.lvl < r.height
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = x.lvl AND s.i = xor(l.pos >> x.lvl, 1)
  UNION ALL
  SELECT l.lang, l.pos, 100 + x.lvl, ((r.pos >> x.lvl) & 1) = 1, s.d
  FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
  JOIN range(0, 64) x(lvl) ON x.lvl < (SELECT max(lvl) FROM tops)
  LEFT JOIN tops s ON s.lvl = x.lvl AND s.i = xor(r.pos >> x.lvl, 1)),
paths AS (
  SELECT lang, pos, coalesce(string_agg(d, '' ORDER BY step), '') AS siblings,
    list(CASE WHEN is_left THEN 'L' ELSE 'R' END || coalesce(d, '') ORDER BY step) AS path
  FROM steps GROUP BY lang, pos),
done AS (
  SELECT l.doc_id, l.leaf, r.subroot, (SELECT d FROM tops WHERE c = 1) AS root,
    sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_concat([l.given], coalesce(p.path, [])),
      lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos)
SELECT *, folded_root = root AS verified FROM done
"""


@query("op12_merkle_manifest", SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    changed = F.when(tampered, _leaf(n_chars=F.col("n_chars") + 1))
    rows = manifest(docs.select("doc_id", "lang", _leaf().alias("leaf"), changed.alias("changed")))
    rows = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
