"""Centroid clustering in integers by Shallot search.

Every vector remembers its nearest and second-nearest centroid, an upper bound on the distance to the one and a lower
bound on the distance to all others. After centroids move the bounds move with them, and a vector whose bounds are
apart keeps its centroid without any distance. Others start from the closer of the two remembered centroids and walk
that one's neighbours by distance; the ball that can still hold one of the two nearest shrinks with every find, and
the walk ends at the first neighbour outside. Survivors are compared by squared distances in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.sources.scratch import Workspace

# Squared distances of 64 components stay within a long up to this size of a component.
LARGEST = 1 << 27
# Bounds are doubles; they decide only where they differ by more than their rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Clustering:
    """``assigned``: every kept row with cluster and distance; ``centroids``: one integer vector for each number."""

    assigned: DataFrame
    centroids: np.ndarray


def integers(embedding: Column, scale: int) -> Column:
    """Components as floor(scale * x), cut at 2^27 either way."""
    return F.transform(
        embedding, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    )


def usable(embedding: Column, size: int) -> Column:
    """Whether a vector has exactly ``size`` components, all finite."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce((F.size(embedding) == size) & F.forall(embedding, finite), F.lit(False))


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, exact."""
    apart = vectors - centroids
    return np.einsum("ij,ij->i", apart, apart)


class Search:
    """One assignment of vectors to fixed centroids; ``before`` are the centroids that the bounds belong to."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None) -> None:
        self.centroids, self.k = centroids, len(centroids)
        between = np.array([distances(centroids, c[None, :]) for c in centroids], np.int64).reshape(self.k, self.k)
        order = np.argsort(between, axis=1, kind="stable")
        # The centroid itself first, whatever equals it.
        self.order = np.array([[c, *row[row != c]] for c, row in enumerate(order)], np.int64)
        self.between = np.sqrt(np.take_along_axis(between, self.order, axis=1).astype(float)) * (1 - SLACK)
        self.moved = np.zeros(self.k)
        if before is not None:
            self.moved = np.sqrt(distances(centroids, before).astype(float)) * (1 + SLACK)
        far = np.argsort(self.moved)[::-1]
        # For each centroid the farthest move of any other.
        self.others_moved = np.full(self.k, self.moved[far[0]] if self.k else 0.0)
        if self.k > 1:
            self.others_moved[far[0]] = self.moved[far[1]]
        self.computed = 0

    def _to(self, vectors: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        self.computed += len(numbers)
        return distances(vectors, self.centroids[numbers])

    def assign(self, vectors: np.ndarray, nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        """(nearest, second, upper, lower) after the move; ``second`` is -1 where there is but one centroid."""
        nearest, second = nearest.copy(), second.copy()
        upper = upper + self.moved[nearest]
        lower = lower - self.others_moved[nearest]
        if self.k == 1:
            return nearest, second, upper, lower
        open_rows = np.flatnonzero(~(upper * (1 + SLACK) < lower))
        if len(open_rows):
            tight = self._to(vectors[open_rows], nearest[open_rows])
            upper[open_rows] = np.sqrt(tight.astype(float)) * (1 + SLACK)
            stay = upper[open_rows] * (1 + SLACK) < lower[open_rows]
            rows = open_rows[~stay]
            if len(rows):
                found = self._walk(vectors[rows], nearest[rows], second[rows], tight[~stay])
                nearest[rows], second[rows], first, next_one = found
                upper[rows] = np.sqrt(first.astype(float)) * (1 + SLACK)
                lower[rows] = np.sqrt(next_one.astype(float)) * (1 - SLACK)
        return nearest, second, upper, lower

    def _walk(self, vectors: np.ndarray, near: np.ndarray, other: np.ndarray, d_near: np.ndarray):
        d_other = self._to(vectors, other)
        swap = (d_other < d_near) | ((d_other == d_near) & (other < near))
        best, d_best = np.where(swap, other, near), np.where(swap, d_other, d_near)
        next_, d_next = np.where(swap, near, other), np.where(swap, d_near, d_other)
        centre = best.copy()
        reach = np.sqrt(d_best.astype(float)) * (1 + SLACK)
        rows = np.arange(len(vectors))
        for step in range(1, self.k):
            # Outside the ball a centroid is farther than the second best found so far.
            ball = reach[rows] + np.sqrt(d_next[rows].astype(float)) * (1 + SLACK)
            rows = rows[self.between[centre[rows], step] <= ball]
            if not len(rows):
                break
            number = self.order[centre[rows], step]
            new = (number != best[rows]) & (number != next_[rows])
            at, number = rows[new], number[new]
            if not len(at):
                continue
            d = self._to(vectors[at], number)
            first = (d < d_best[at]) | ((d == d_best[at]) & (number < best[at]))
            after = ~first & ((d < d_next[at]) | ((d == d_next[at]) & (number < next_[at])))
            a = at[first]
            next_[a], d_next[a] = best[a], d_best[a]
            best[a], d_best[a] = number[first], d[first]
            b = at[after]
            next_[b], d_next[b] = number[after], d[after]
        return best, next_, d_best, d_next


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    """Packed 32-bit vectors of a batch as one array of longs."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), size).astype(np.int64)


def _fields(rest: T.DataType, **more: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("rest", rest), *(T.StructField(n, t) for n, t in more.items())])


def _assigned(state: DataFrame, size: int, centroids: np.ndarray, before: np.ndarray | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids, before)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            near, second, upper, lower = (at[n].to_numpy() for n in ["nearest", "second", "upper", "lower"])
            found = search.assign(_vectors(at["vector"], size), near.astype(np.int64), second.astype(np.int64), upper, lower)
            was = near if before is not None else np.full(batch.num_rows, -1)
            made = [pa.array(x, t) for x, t in zip([*found, was], [pa.int32(), pa.int32(), None, None, pa.int32()], strict=True)]
            yield pa.RecordBatch.from_arrays([at["rest"], at["vector"], *made], names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def _changes(state: DataFrame, size: int, k: int) -> np.ndarray:
    """What moved vectors add to and take from the sums (and, last, the counts) of the centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column(0), size)
            vectors = np.hstack([vectors, np.ones((len(vectors), 1), np.int64)])
            to, was = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for c in range(k):
                sums[c] += vectors[to == c].sum(axis=0) - vectors[was == c].sum(axis=0)
        c, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(j, pa.int32()), pa.array(sums[c, j])], names=["c", "j", "s"]
        )

    moved = state.filter("nearest <> was").select("vector", "nearest", "was").mapInArrow(run, "c int, j int, s long")
    out = np.zeros((k, size + 1), object)
    # One row for each centroid and component, whatever the table.
    for r in moved.groupBy("c", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r.c, r.j] = int(r.s)
    return out


def cluster(
    rows: DataFrame,
    k: int = 16,
    rounds: int = 3,
    size: int = 64,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    seed: str = "1",
) -> Clustering:
    """Rows with a usable vector, without that column, with ``cluster`` and ``distance`` (squared), and the centroids.

    A vector is usable with exactly ``size`` components, none NULL or non-finite; components become the integers
    floor(scale * x), cut at 2^27 either way so that distances fit a long. The centroids start as the k vectors with
    the smallest sha256 of `seed:key` (a NULL key as the empty text, equal keys by their components; fewer than k if
    the table has fewer). Each round assigns all vectors, ties to the smaller number, and makes every non-empty
    centroid the floor of its exact mean; then all are assigned once more. Repeated rows count each. All other columns
    stay; those named cluster or distance are replaced. An empty table, or one without usable vectors, gives no rows
    and no centroids. Every pass is narrow: rows are written with their bounds, never shuffled.
    """
    plain = rows.drop("cluster", "distance")
    rest = [c for c in plain.columns if c != vector]
    work = Workspace(rows.sparkSession, "shallot")
    with work:
        kept = plain.filter(usable(F.col(f"`{vector}`"), size))
        v = integers(F.col(f"`{vector}`"), scale)
        digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
        start = kept.select(digest.alias("h"), v.alias("v")).orderBy("h", "v").limit(k).collect()
        n = len(start)
        centroids = np.array([r.v for r in start], np.int64).reshape(n, size)
        if not n:
            names = [F.col(f"`{c}`") for c in rest]
            return Clustering(kept.limit(0).select(*names, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids)
        # Nothing is known at first: without a lower bound every vector searches, from centroid 0 or 1.
        state = _packed(kept.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), v.alias("v"))).select(
            "rest", "vector", F.lit(0).alias("nearest"), F.lit(1 if n > 1 else -1).alias("second"),
            F.lit(0.0).alias("upper"), F.lit(float("-inf")).alias("lower"), F.lit(-1).alias("was"),
        )
        before, sums = None, np.zeros((n, size + 1), object)
        for r in range(rounds):
            state = work.save(_assigned(state, size, centroids, before), f"state{r}")
            if r:
                work.drop(f"state{r - 1}")
            sums = sums + _changes(state, size, n)
            before = centroids
            means = [[x // s[-1] for x in s[:-1]] if s[-1] else c.tolist() for s, c in zip(sums.tolist(), before, strict=True)]
            centroids = np.array(means, np.int64).reshape(n, size)
        out = work.save(_with_distance(_assigned(state, size, centroids, before), size, centroids), "assigned")
        work.keep("assigned")
    columns = [F.col(f"rest.`{c}`").alias(c) for c in rest]
    return Clustering(out.select(*columns, "cluster", "distance"), centroids)


def _packed(kept: DataFrame) -> DataFrame:
    """Integer vectors packed as 32-bit little-endian binaries, for the passes over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(batch.num_rows, -1)
                packed = pa.array([v.tobytes() for v in vectors], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["rest", "vector"])

    return kept.mapInArrow(run, _fields(kept.schema["rest"].dataType, vector=T.BinaryType()))


def _with_distance(state: DataFrame, size: int, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = batch.column(2).to_numpy().astype(np.int64)
                d = pa.array(distances(_vectors(batch.column(1), size), centroids[near]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), d], names=["rest", "cluster", "distance"])

    schema = _fields(state.schema["rest"].dataType, cluster=T.IntegerType(), distance=T.LongType())
    return state.select("rest", "vector", "nearest").mapInArrow(run, schema)


def centroid_digest(centroid: np.ndarray) -> str:
    """SHA-256 over the components as decimal integers, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()
