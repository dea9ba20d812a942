import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from text_cases import SF001

from runwaylens.llm.q13_shallot import op13_shallot_clusters
from runwaylens.llm.shallot import LARGEST, Search, centroid_digest, cluster, distances


def brute(vectors, k, rounds, scale, seed="1"):
    """vectors: (key, components). Returns (cluster and distance of each kept vector, centroids)."""
    size = len(vectors[0][1]) if vectors else 0
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if len(v) == size]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if (g := groups.get(j)) else c for j, c in enumerate(centroids)]
    return sorted((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centroids


def both(spark, vectors, k=4, rounds=3, scale=8):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    found = cluster(df, k=k, rounds=rounds, size=len(vectors[0][1]), scale=scale)
    got = sorted((r.vec_id, r.cluster, r.distance) for r in found.assigned.collect())
    return (got, found.centroids.tolist()), brute(vectors, k, rounds, scale)


def test_equal_to_brute_force(spark):
    rng = random.Random(1)
    centres = [[rng.uniform(-2, 2) for _ in range(5)] for _ in range(6)]
    vectors = [(i, [c + rng.gauss(0, 0.3) for c in centres[i % 6]]) for i in range(900)]
    got, want = both(spark, vectors, k=9, scale=64)
    assert got == want


def test_ties_repeats_and_hot_vectors(spark):
    """Few distinct vectors on a grid, a third of all rows equal: ties go to the smaller number, some centroids stay empty."""
    rng = random.Random(2)
    vectors = [(i, [float(rng.randint(-1, 1)) for _ in range(2)]) for i in range(200)] + [(7, [1.0, 1.0])] * 100
    got, want = both(spark, vectors, k=12, scale=1)
    assert got == want
    got, want = both(spark, [(i, [0.0, 0.0]) for i in range(9)], k=4)
    assert got == want and {c for _, c, _ in got[0]} == {0}


@pytest.mark.parametrize("k", [1, 2, 5])
def test_fewer_vectors_than_centroids(spark, k):
    got, want = both(spark, [(1, [0.5, -3.25]), (2, [4.0, 1.0]), (3, [4.0, 1.5])], k=k)
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 7), st.integers(1, 40), st.integers(0, 10_000), st.integers(1, 4))
def test_search_with_bounds_equals_full_scans(k, n, seed, spread):
    """Several moves of the centroids in a row, with the bounds carried along."""
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (n, 3)).astype(np.int64)
    centroids, before = rng.integers(-spread, spread + 1, (k, 3)).astype(np.int64), None
    state = np.zeros(n, np.int64), np.full(n, 1 if k > 1 else -1), np.zeros(n), np.full(n, -np.inf)
    for _ in range(4):
        state = Search(centroids, before).assign(vectors, *state)
        every = np.array([distances(vectors, c[None, :]) for c in centroids])
        assert (state[0] == every.argmin(axis=0)).all()
        if k > 1:
            assert (state[1] != state[0]).all()
            ordered = np.sqrt(np.sort(every, axis=0))
            assert (state[2] * (1 + 1e-6) + 1e-6 >= ordered[0]).all() and (state[3] <= ordered[1] * (1 + 1e-6) + 1e-6).all()
        before, centroids = centroids, centroids + rng.integers(-1, 2, centroids.shape)


def test_search_computes_far_fewer_distances():
    rng = np.random.default_rng(5)
    centres = rng.integers(-1000, 1000, (16, 8))
    vectors = (centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 41, (4000, 8))).astype(np.int64)
    state = np.zeros(4000, np.int64), np.ones(4000, np.int64), np.zeros(4000), np.full(4000, -np.inf)
    state = Search(centres).assign(vectors, *state)
    again = Search(centres + 1, centres)
    again.assign(vectors, *state)
    assert again.computed < 4000


def test_query_keeps_usable_vectors_only(spark):
    out = op13_shallot_clusters(spark, SF001)
    table = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table]
    want, centroids = brute(rows, 16, 3, 64)
    got = sorted((r.vec_id, r.cluster, r.distance) for r in out.collect())
    assert got == want
    inertia = {}
    for _, c, d in want:
        inertia[c] = inertia.get(c, 0) + d
    for r in out.collect():
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        assert r.centroid_sha256 == centroid_digest(centroids[r.cluster])


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, math.nan]), (6, [math.inf, 0.0]),
        (7, [1e300, -1e300]), (None, [0.5, 0.5]), (8, [0.0, 0.0]), (8, [0.0, 0.0]), (9, [0.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ["cluster", "rest", "vector", "nearest", "was", "row_id", "h", "v", "a.b"]:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    found = cluster(df, k=2, size=2)
    assert found.assigned.columns == [c for c in df.columns if c not in ("cluster", "embedding")] + ["cluster", "distance"]
    got = found.assigned.collect()
    assert sorted((r.vec_id for r in got), key=str) == [7, 8, 8, None]
    assert all(r.rest == r["a.b"] == "x" for r in got) and abs(found.centroids).max() <= LARGEST
    for nothing in (df.limit(0), df.filter("vec_id < 7")):
        empty = cluster(nothing, size=2)
        assert empty.assigned.count() == 0 and empty.centroids.shape == (0, 2) and empty.assigned.columns == found.assigned.columns
