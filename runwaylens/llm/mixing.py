"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken the same, mostly broken, number of times. The whole part is taken; of the
rest, pairs of documents exchange words at random until one of them is taken or left, so each keeps its expected
share and the words of the source stay the same. Pairs are made inside small groups of documents; what stays broken
in a group goes up a reduction tree, 32 groups into one, each leaving a handful per source and size. The last are settled
from the largest to the smallest, the others taking up its words, until one is broken: that one is drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.llm.common import word_count
from runwaylens.sources.scratch import Workspace

MOST = 3.0
WEIGHTS = (1, 2, 3)
# Documents of a leaf of the reduction tree, groups that join into one, and documents of a size class that a group leaves.
LEAF = 2000
FAN = 32
REST = 24
_EPS = 1e-9


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, number, source_size, target): words each source should give; one row per source.

    Sources in code point order, NULL last, take the weights in turn and share the words of all documents; no target
    exceeds ``most`` times its source's words, what is cut goes to the others by weight until nothing is above.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1)
    named = sources.select("source", "source_size", place.alias("number")).withColumn("weight", weight)
    named = named.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    # Capped are the sources with the lowest caps for their weight; the rest get `level` words per weight.
    below = Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    filled = named.withColumn("level", left / weight_left)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("number_in_order", "level"))).over(everything)["level"]
    order = F.row_number().over(Window.orderBy("ratio", "number"))
    filled = filled.withColumn("number_in_order", order).withColumn("line", level)
    target = F.least("cap", F.coalesce(F.col("line"), F.lit(float("inf"))) * F.col("weight"))
    return filled.select("source", "number", "source_size", target.alias("target"))


def row_key(df: DataFrame) -> list[Column]:
    """Two hashes of all columns of a row; equal rows have equal keys, whatever is NULL in them."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [F.xxhash64(*plain).alias("__k1"), F.hash(*plain, F.lit(7)).alias("__k2")]


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8], "little")


def pivot(p: np.ndarray, size: np.ndarray, keep: int, rng: np.random.Generator) -> np.ndarray:
    """Exchange words between documents until at most ``keep`` are broken; returns the new shares, most 0 or 1."""
    p = p.copy()
    draws = rng.random(len(p))
    at = 0
    for other in range(1, len(p) - keep + 1):
        up = min((1 - p[at]) * size[at], p[other] * size[other])
        down = min(p[at] * size[at], (1 - p[other]) * size[other])
        move = up if draws[other] * (up + down) < down else -down
        p[at] += move / size[at]
        p[other] -= move / size[other]
        for i in (at, other):
            if min(p[i], 1 - p[i]) < _EPS:
                p[i] = round(p[i])
        if p[at] in (0.0, 1.0):
            at = other
    return p


def settle(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round the last documents of a source, largest first; each is taken with the probability of its share.

    The largest becomes whole at once where the others together can give or take its words, each by the room that it
    has; else it is paired with the next. The words stay the same until the last document, which is drawn.
    """
    p = p.copy()
    order = np.lexsort((np.arange(len(p)), -size))
    while len(order := order[(p[order] > 0) & (p[order] < 1)]) > 1:
        i, others = order[0], order[1:]
        have, room = p[others] * size[others], (1 - p[others]) * size[others]
        gain, loss = (1 - p[i]) * size[i], p[i] * size[i]
        part = np.minimum(have / gain, room / loss)
        if part.sum() < 1:
            p[order[:2]] = pivot(p[order[:2]], size[order[:2]], 1, rng)
            continue
        taken = rng.random() < p[i]
        p[others] += (-gain if taken else loss) * part / part.sum() / size[others]
        p[i] = float(taken)
        near = np.minimum(p[others], 1 - p[others]) < _EPS
        p[others[near]] = p[others[near]].round()
    p[order] = rng.random(len(order)) < p[order]
    return p


def _reduce(part: pd.DataFrame, seed: int, last: bool) -> pd.DataFrame:
    part = part.sort_values(["number", "octave", "__k1", "__k2", "size"], kind="stable", ignore_index=True)
    p, size = part["p"].to_numpy().copy(), part["size"].to_numpy(float)
    for source, rows in part.groupby("number", sort=True).indices.items():
        octaves = part["octave"].to_numpy()[rows]
        for octave in np.unique(octaves):
            own = rows[octaves == octave]
            rng = np.random.default_rng(_seed(seed, source, octave, int(part["__k1"].iloc[own[0]])))
            p[own] = pivot(p[own], size[own], REST, rng)
        if last:
            broken = rows[(p[rows] > 0) & (p[rows] < 1)]
            p[broken] = settle(p[broken], size[broken], np.random.default_rng(_seed(seed, source, "settle")))
    return part.assign(p=p)


def _reducer(seed: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def step(part: pd.DataFrame) -> pd.DataFrame:
        return _reduce(part, seed, last)

    return step


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 17) -> DataFrame:
    """How often each row of ``docs`` (doc_id, text, source, and any others) is taken.

    Returns __k1, __k2 (key of equal rows), doc_id, size, source_size, target, m (equal rows), copies (times that they
    are taken together). Size is the words of the whole text, 0 for NULL. Texts without words are taken as often as
    they are there. Equal rows share one line; no row is taken more than ``most`` times (rounded up). The plan hangs
    on ``seed`` and the rows alone, so reruns agree on any cluster. An empty table gives an empty plan.
    """
    keyed = docs.select(*row_key(docs), "doc_id", "source", word_count(F.col("text")).alias("size"))
    with Workspace(docs.sparkSession, "mixing") as work:
        units = work.save(keyed.groupBy("__k1", "__k2", "doc_id", "source", "size").agg(F.count("*").alias("m")), "units")
        targets = work.save(source_targets(units.select("source", (F.col("size") * F.col("m")).alias("size")), weights, most), "targets")
        joined = units.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        expected = F.when(F.col("size") > 0, rate * F.col("m")).otherwise(F.col("m").cast("double"))
        whole = F.floor(expected + _EPS)
        planned = joined.select(
            "__k1",
            "__k2",
            "doc_id",
            "size",
            "source_size",
            "target",
            "m",
            "number",
            F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("octave"),
            whole.cast("long").alias("base"),
            F.greatest(expected - whole, F.lit(0.0)).alias("p"),
        ).withColumn("p", F.when(F.col("p") < _EPS, 0.0).otherwise(F.col("p")))
        leaves = max(1, -(-units.count() // LEAF))
        level = work.save(planned.withColumn("leaf", F.pmod("__k1", F.lit(leaves)).cast("long")), "level0")
        work.keep("level0")
        done = [level.filter("p = 0 or p = 1")]
        depth = 0
        while True:
            wide = FAN**depth
            last = wide >= leaves
            open_rows = level.filter("p > 0 and p < 1")
            grouped = open_rows.groupBy(
                F.floor(F.col("leaf") / wide).alias("node"), F.pmod("number", F.lit(wide)).alias("part")
            )
            depth += 1

            level = work.save(grouped.applyInPandas(_reducer(_seed(seed, depth), last), level.schema), f"level{depth}")
            work.keep(f"level{depth}")
            done.append(level.filter("p = 0 or p = 1"))
            if last:
                break
    plan = done[0]
    for part in done[1:]:
        plan = plan.unionByName(part)
    copies = F.col("base") + F.col("p").cast("long")
    return plan.select("__k1", "__k2", "doc_id", "size", "source_size", "target", "m", copies.alias("copies"))


def per_row(plan: DataFrame) -> DataFrame:
    """One line for each row of the documents, with the times that it alone is taken."""
    each = plan.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    own = F.floor(F.col("copies") / F.col("m")) + (F.col("__i") <= F.col("copies") % F.col("m")).cast("long")
    return each.withColumn("copies", own.cast("long")).drop("__i", "m")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 17) -> DataFrame:
    """``docs`` with every row as often as the plan takes it; columns stay as they are."""
    plan = mix_plan(docs, weights, most, seed).filter("copies > 0")
    plan = plan.select("__k1", "__k2", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("__each"))
    keyed = docs.select("*", *row_key(docs)).dropDuplicates(["__k1", "__k2"])
    repeated = keyed.join(plan, ["__k1", "__k2"]).withColumn("__i", F.explode("__each"))
    return repeated.select(*docs.columns)
