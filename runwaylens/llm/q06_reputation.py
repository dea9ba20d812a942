"""Query: verdict on every page's url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runwaylens.llm.common import table
from runwaylens.llm.registry import query
from runwaylens.llm.reputation import DEVIATIONS, LEAST_RATE, LONG_SUFFIXES, judge

# The rules of this query.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def _fits(rule: str) -> str:
    name, _, start = rule.partition("/")
    return f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}'))"


def _level(keys: str, above: str, join: str) -> str:
    return f"""
  SELECT {keys}, sum(g) AS g, sum(n) AS n, any_value({above}.mean) AS prior FROM h JOIN {above} {join} GROUP BY {keys}
"""


def _mean(level: str, keys: str) -> str:
    return f"""
  SELECT {keys}, (g + prior * s) / (n + s) AS mean, n + s AS mass FROM {level}, (
    SELECT CASE WHEN count(*) = 0 THEN 1.0 WHEN spread - noise <= 0 THEN 10000.0
      ELSE least(10000.0, greatest(1.0, (v / n) / ((spread - noise) / n) - 1)) END AS s FROM (
      SELECT sum(n) AS n, sum(n * power(g / n - prior, 2)) AS spread, sum(prior * (1 - prior)) AS noise,
        sum(n * prior * (1 - prior)) AS v FROM {level} WHERE n > 0) GROUP BY spread, noise, v, n)
"""


_ORDER = sorted(RULES, key=lambda r: (len(r[1]), r[1]), reverse=True)
SQL = f"""
WITH s AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), r AS (
  SELECT *, CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in _ORDER)} END AS rule,
    CASE {" ".join(f"WHEN {_fits(r)} THEN '{v}'" for v, r in _ORDER)} END AS told FROM s
), l AS (
  SELECT host, string_split(host, '.') AS p, CAST(sum(CASE WHEN told = 'allow' THEN 1 ELSE 0 END) AS DOUBLE) AS g,
    CAST(count(told) AS DOUBLE) AS n FROM r GROUP BY host
), t AS (
  SELECT *, array_to_string(p[greatest(len(p) - 1, 1):], '.') AS two, array_to_string(p[greatest(len(p) - 2, 1):], '.') AS three
  FROM l
), h AS (
  SELECT host, g, n, CASE WHEN two IN ({", ".join(f"'{x}'" for x in LONG_SUFFIXES)}) THEN two ELSE p[len(p)] END AS suffix,
    CASE WHEN two IN ({", ".join(f"'{x}'" for x in LONG_SUFFIXES)}) THEN three ELSE two END AS domain FROM t
), l0 AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(g) + 0.5) / (sum(n) + 1) ELSE 0.5 END AS mean FROM h),
l1 AS ({_level("h.suffix", "l0", "ON true")}), m1 AS ({_mean("l1", "suffix")}),
l2 AS ({_level("h.suffix, h.domain", "m1", "ON h.suffix = m1.suffix")}), m2 AS ({_mean("l2", "suffix, domain")}),
l3 AS ({_level("h.suffix, h.domain, h.host", "m2", "ON h.suffix = m2.suffix AND h.domain = m2.domain")}),
m3 AS ({_mean("l3", "suffix, domain, host")})
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.told,
  CASE WHEN mean + {DEVIATIONS} * sqrt(mean * (1 - mean) / (mass + 1)) < {LEAST_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM r JOIN m3 ON r.host = m3.host
"""


@query("op6_host_reputation", SQL)
def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
