"""Query: centroid clusters of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.llm.common import table
from runwaylens.llm.registry import query
from runwaylens.llm.shallot import centroid_digest, cluster

CENTROIDS, ROUNDS = 16, 3


def _sql() -> str:
    """The rounds one after the other, each assignment a minimum over (distance, number)."""
    parts = [
        """kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE)))),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT v, sha256('1:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h LIMIT 16))"""
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS m
  FROM (SELECT k.rid, k.vec_id, k.v, c.c,
    list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept k, c{r} c)
  GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""c{r + 1} AS (
  SELECT c.c, coalesce(s.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT c, list(f ORDER BY j) AS v FROM (
      SELECT m.c AS c, j, ((sum(v[j]) - ((sum(v[j]) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS f
      FROM a{r}, range(1, 65) t(j) GROUP BY m.c, j) GROUP BY c) s ON s.c = c.c)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
  (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c ON c.c = m.c"""


@query("op13_shallot_clusters", _sql())
def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = cluster(vectors, k=CENTROIDS, rounds=ROUNDS)
    # One row for each centroid.
    sums = {r.cluster: r.s for r in found.assigned.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    whole = None if None in sums.values() or sum(sums.values()) >= 1 << 63 else sum(sums.values())
    inertia = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(found.centroids))])
    digests = F.array(*[F.lit(centroid_digest(c)) for c in found.centroids])
    return found.assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(inertia, F.col("cluster")).cast("long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        F.get(digests, F.col("cluster")).cast("string").alias("centroid_sha256"),
    )
