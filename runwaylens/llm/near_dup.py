"""Near-duplicate groups of documents from bottom-k sketches of one hash function.

1. Each text becomes its set of hashed word shingles; documents with equal sets form one class, and all
   further work is on classes. The ``k`` smallest hashes of a set are its sketch.
2. The smallest values of the sketches form inverted lists. Two sets that are similar enough share many of these
   values, so a class with too few values in common with anybody leaves, and the others keep only as many of
   their rarest values as are needed to meet every partner (prefix filter over the retained values).
3. Neighbours in sorted lists are compared first: the sketch of the union estimates the similarity, and the full
   sets confirm it. Members of large lists meet in one sweep for all lists, so that no pair is made once for each list.
   Confirmed links are contracted to components.
4. What is left are lists that still hold several components. The classes of large ones get new lists, from their full
   sets: a shingle that only one component holds links nothing, so a class with too few others leaves, and the others
   keep as many of their rarest ones as are needed to meet every partner. Lists that are still large are cut by the
   size of the sets. Only pairs across components are compared there, and no link that joins components is lost.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.llm.common import WORD, small_batches
from runwaylens.sources.scratch import Workspace

SHINGLE = 5
K = 64
# Values of a sketch that go into inverted lists.
LISTED = 32
# Lists of up to so many classes are joined with themselves; larger ones are compared in blocks of BLOCK classes.
SMALL_LIST = 50
BLOCK = 512
# Shingles of full sets that a task lists.
LISTED_AT_ONCE = 25_000
# A true link is missed by a sketch test with less than this probability.
MISS = 1e-9
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


class _WordHash(dict):
    """64-bit hash of each word, kept for words met before; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASH = _WordHash()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a whole text.

    A-Z are lower-cased; words part at ASCII white space. Fewer than ``n`` words: one shingle of all of them.
    No text or no words: the empty set.
    """
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    w = np.array(list(map(_HASH.__getitem__, words)), np.uint64)
    width = min(n, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        h = _mixed(h * _MIX[2] + w[i : len(w) - width + 1 + i])
    return np.unique(h.view(np.int64))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(sets) + 1, np.int32)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))


def with_sketches(docs: DataFrame, n: int = SHINGLE, k: int = K) -> DataFrame:
    """Every row with ``__n`` (shingles), ``__cls`` (128-bit digest of the set; NULL if empty) and ``__sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t.as_py(), n) for t in batch.column(batch.schema.get_field_index("text"))]
            more = {
                "__n": pa.array([len(s) for s in sets], pa.int64()),
                "__cls": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                "__sketch": _lists([s[:k] for s in sets]),
            }
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more.values()], names=[*batch.schema.names, *more]
            )

    fields = [
        T.StructField("__n", T.LongType()),
        T.StructField("__cls", T.BinaryType()),
        T.StructField("__sketch", T.ArrayType(T.LongType())),
    ]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def least_shared(m: int, similarity: float) -> int:
    """Shared values out of ``m`` retained ones that a pair of at least this similarity has all but surely.

    Each of the m smallest values of the union is shared with probability ``similarity``; this is the largest t
    for which fewer than t shared values have a probability below MISS.
    """
    below = 0.0
    for t in range(m + 1):
        below += math.comb(m, t) * similarity**t * (1 - similarity) ** (m - t)
        if below > MISS:
            return t
    return m


def _needed(n: Column, similarity: float) -> Column:
    """How many listed values a class of ``n`` shingles shares with every partner."""
    whole = n <= F.lit(math.floor(LISTED * similarity))
    return F.when(whole, F.ceil(n * F.lit(similarity) - 1e-9)).otherwise(least_shared(LISTED, similarity)).cast("int")


def _value_lists(reps: DataFrame, similarity: float) -> DataFrame:
    """(value, cls, n): the values that the prefix filter leaves each class."""
    listed = reps.select("cls", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    shared = listed.groupBy("value").agg(F.count("*").alias("f")).filter("f > 1")
    mine = (
        listed.join(shared, "value")
        .groupBy("cls", "n")
        .agg(F.array_sort(F.collect_list(F.struct("f", "value"))).alias("own"))  # LISTED entries at most
    )
    spare = F.size("own") - _needed(F.col("n"), similarity) + 1
    return (
        mine.filter(spare > 0)
        .select("cls", "n", F.explode(F.slice("own", F.lit(1), spare)).alias("o"))
        .select(F.col("o.value").alias("value"), "cls", "n")
    )


def _neighbours(lists: DataFrame, reps: DataFrame, width: int = 3) -> DataFrame:
    """Pairs (a, b) of classes that stand next to each other in a list sorted by sketch."""
    keyed = lists.join(reps.select("cls", F.slice("sketch", 1, LISTED).alias("order")), "cls")
    ordered = keyed.select("value", "order", "cls").repartitionByRange("value", "order", "cls")
    ordered = ordered.sortWithinPartitions("value", "order", "cls").select("value", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, classes = np.empty(0, np.int64), []
        for batch in batches:
            values = np.concatenate([values, batch.column(0).to_numpy()])
            classes = classes + batch.column(1).to_pylist()
            pairs = {
                (min(classes[i], classes[i + d]), max(classes[i], classes[i + d]))
                for d in range(1, width + 1)
                for i in np.flatnonzero(values[:-d] == values[d:])
            }
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())}
            )
            values, classes = values[-width:], classes[-width:]

    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def _swept(lists: DataFrame, reps: DataFrame, work: Workspace, similarity: float, k: int, width: int = 3) -> DataFrame:
    """Pairs (a, b) of classes near each other in large lists, without those that the sketch of the union rules out.

    Members of large lists share many of them. So a class comes once, with all its lists, in the order of the sketches,
    and meets the last ``width`` classes before it in each of them: a pair is tested once, however many lists hold it.
    Tasks cut the lists, so all classes come a second time, in an order by other hashes, which is cut elsewhere.
    """
    own = lists.groupBy("cls").agg(F.collect_list("value").alias("own"))  # LISTED values at most
    own = work.save(own.join(reps, "cls"), "own-large")
    first = F.slice("sketch", 1, LISTED)
    orders = F.array(first, F.array_sort(F.transform(first, lambda v: F.xxhash64(v))))
    ordered = own.select(F.posexplode(orders).alias("turn", "order"), "cls", "n", "sketch", "own")
    ordered = ordered.repartitionByRange("turn", "order", "cls").sortWithinPartitions("turn", "order", "cls")

    least = least_shared(k, similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = {}
        for batch in small_batches(batches):
            pairs = []
            for turn, cls, n, sketch, values in zip(*(c.to_pylist() for c in batch.columns)):
                this, met = (cls, n, np.array(sketch, np.int64)), {}
                for v in values:
                    line = last.setdefault((turn, v), deque(maxlen=width))
                    met.update((other[0], other) for other in line)
                    line.append(this)
                near = [c for c, m, s in met.values() if _near(n, this[2], m, s, similarity, k, least)]
                pairs += [(min(cls, c), max(cls, c)) for c in near]
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())}
            )

    return ordered.select("turn", "cls", "n", "sketch", "own").mapInArrow(run, "a binary, b binary").distinct()


def _near(na: int, sa: np.ndarray, nb: int, sb: np.ndarray, similarity: float, k: int, least: int) -> bool:
    """The test of ``_estimated`` for one pair of set sizes and sketches."""
    if min(na, nb) < max(na, nb) * similarity - 1e-6:
        return False
    both = np.intersect1d(sa, sb, assume_unique=True)
    if na <= k and nb <= k:
        return len(both) * (1 + similarity) >= (na + nb) * similarity - 1e-6
    last = np.union1d(sa, sb)[:k][-1]
    return np.searchsorted(both, last, "right") >= least


def _estimated(pairs: DataFrame, reps: DataFrame, similarity: float, k: int) -> DataFrame:
    """The pairs that the sketch of the union does not rule out."""
    side = {
        s: reps.select(F.col("cls").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}")) for s in "ab"
    }
    joined = pairs.join(side["a"], "a").join(side["b"], "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    whole = (F.col("na") <= k) & (F.col("nb") <= k)
    # Sets that fit into their sketches are known exactly.
    exact = F.size(F.array_intersect("sa", "sb")) * (1 + similarity) >= (F.col("na") + F.col("nb")) * similarity - 1e-6
    near = F.when(whole, exact).otherwise(shared >= least_shared(k, similarity))
    sizes = F.least("na", "nb") >= F.greatest("na", "nb") * similarity - 1e-6
    return joined.filter(sizes & near).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets meet 100 * intersection >= percent * union."""
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("xa"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    union = F.size("xa") + F.size("xb") - both
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * union).select("a", "b")


def components(links: DataFrame, work: Workspace, label: str) -> DataFrame:
    """(cls, root) for every class with a link; root is the smallest class of its component.

    Alternating large and small stars: a class hands its neighbours to its smallest neighbour. Every round is
    written to the shared folder; the number of rounds grows with the logarithm of a component's diameter.
    """
    edges = work.save(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}0")
    before, step = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: the neighbours below u, and u itself, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        step += 1
        new = work.save(small.filter("u <> v").distinct(), f"{label}{step}")
        work.drop(f"{label}{step - 1}")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = new
        if state == before:
            break
        before = tuple(state)
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("cls"), "root").unionByName(
        edges.select(F.col("v").alias("cls"), F.col("v").alias("root")).distinct()
    )


def _rare_lists(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(value, cls, n, root): the classes of large lists, in lists of their rarest shingles instead.

    A partner in another component shares ``percent`` of a class's shingles at least, all of them held by more than one
    component. Of these a class keeps its rarest, so many that fewer than it must share are left; two partners then
    keep their rarest common one both. Exact, as it reads the full sets.
    """
    classes = large.select("cls", "root", "n").distinct()
    total = classes.agg(F.sum("n")).first()[0] or 0
    tasks = total // LISTED_AT_ONCE + large.sparkSession.sparkContext.defaultParallelism
    crowd = classes.join(sets, "cls").repartition(tasks)
    each = crowd.select("cls", "root", "n", F.explode("shingles").alias("value"))
    held = Window.partitionBy("value")
    counted = each.withColumns(
        {"f": F.count("*").over(held), "least": F.min("root").over(held), "most": F.max("root").over(held)}
    )
    mine = (
        counted.filter("least <> most")
        .groupBy("cls", "root", "n")
        .agg(F.array_sort(F.collect_list(F.struct("f", "value"))).alias("own"))  # the shingles of one text at most
    )
    needed = F.expr(f"cast((n * {percent} + 99) div 100 as int)")
    spare = F.size("own") - needed + 1
    kept = mine.filter(spare > 0).select("cls", "root", "n", F.explode(F.slice("own", F.lit(1), spare)).alias("o"))
    return kept.select(F.col("o.value").alias("value"), "cls", "n", "root")


def _split(members: DataFrame) -> DataFrame:
    """(value, parts, size) of the lists that hold several components."""
    return (
        members.groupBy("value", "root").agg(F.count("*").alias("c"))
        .groupBy("value").agg(F.count("*").alias("parts"), F.sum("c").alias("size"))
        .filter("parts > 1")
    )


def _by_size(members: DataFrame, similarity: float) -> DataFrame:
    """The lists cut by the size of the sets: classes stay together only with those of a size that can be similar.

    Sizes fall into levels, of which each is 1 / similarity of the one before; linked classes are of one level or of
    neighbouring ones. The list of a level holds it and the one below. Lists of one component are left out.
    """
    level = F.floor(F.log(F.col("n").cast("double")) / -math.log(similarity - 1e-6))
    cut = members.select(F.explode(F.array(level, level + 1)).alias("level"), "value", "cls", "root")
    cut = cut.select(F.xxhash64("value", "level").alias("value"), "cls", "root")
    several = cut.groupBy("value").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    return cut.join(several.select("value"), "value", "left_semi")


def _wide_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components out of large lists, compared in blocks of bounded size.

    Every block of a list meets every other block of it in a task of its own. A task counts the shared shingles of
    the full sets of two blocks as a matrix product; of the links it finds, it returns those that join components
    not yet joined by the ones before, so at most one for each component that takes part.
    """
    sized = members.groupBy("value").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (
        members.join(sized, "value")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "value",
            "cls",
            "root",
            "block",
            F.least("block", "other").alias("x"),
            F.greatest("block", "other").alias("y"),
        )
    )
    full = placed.join(sets, "cls")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = key[1], key[2]
        left = pdf[pdf.block == x].reset_index(drop=True)
        right = pdf[pdf.block == y].reset_index(drop=True) if x != y else left
        out = []
        if len(left) and len(right):
            shared = _shared(*([list(left.shingles)] * 2 if x == y else (list(left.shingles), list(right.shingles))))
            sizes = left.shingles.str.len().to_numpy()[:, None] + right.shingles.str.len().to_numpy()[None, :]
            roots = pd.factorize(pd.concat([left.root, right.root]))[0]
            over, under = roots[: len(left)], roots[len(left) :]
            linked = (100 * shared >= percent * (sizes - shared)) & (over[:, None] != under[None, :])
            joined = list(range(roots.max() + 1))
            for i, j in zip(*np.nonzero(linked)):
                u, v = _top(joined, over[i]), _top(joined, under[j])
                if u != v:
                    joined[u] = v
                    out.append((left.cls[i], right.cls[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return full.groupBy("value", "x", "y").applyInPandas(compare, "a binary, b binary")


def _top(joined: list[int], i: int) -> int:
    while joined[i] != i:
        joined[i] = joined[joined[i]]
        i = joined[i]
    return i


def _shared(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Matrix of shared values of each left with each right sorted array, a bounded number of columns at a time."""
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    values = [np.concatenate(side) for side in (left, right)]
    if left is right:
        common, times = np.unique(values[0], return_counts=True)
        common = common[times > 1]
    else:
        common = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
    places = [np.searchsorted(common, v) for v in values]
    hit = [(p < len(common)) & (common[np.minimum(p, len(common) - 1)] == v) for p, v in zip(places, values)] if len(common) else None
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(common), columns):
        parts = []
        for side, p, h, r in zip((left, right), places, hit or (), rows):
            here = h & (p >= start) & (p < start + columns)
            m = np.zeros((len(side), min(columns, len(common) - start)), np.float32)
            m[r[here], p[here] - start] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def group_near_duplicates(
    docs: DataFrame, percent: int = 80, n: int = SHINGLE, k: int = K, id_col: str = "doc_id"
) -> DataFrame:
    """(id, cls, root, n_shingles, component_id, text_hash) for every row of ``docs``, by its ``text``.

    Rows are linked when their shingle sets have 100 * intersection >= percent * union; component_id is the smallest
    id that links reach. Links are confirmed on full sets; a link is missed with a probability below 1e-9 at each
    sketch test. Texts that are NULL or have no word have no class (NULL) and stand alone. Equal rows and rows that
    repeat an id are told apart only by their texts; ``root`` names the component itself. A NULL id is smaller than no id: it becomes a component_id only
    where the component has no other. Other columns are not read.
    """
    similarity = percent / 100
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    with Workspace(spark, "near-dup") as work:
        light = work.save(
            with_sketches(base, n, k).select("id", "text_hash", F.col("__cls").alias("cls"), F.col("__n").alias("n"), F.col("__sketch").alias("sketch")),
            "light",
        )
        work.keep("light")
        reps = work.save(
            light.filter("cls is not null").groupBy("cls").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")),
            "reps",
        )
        lists = _value_lists(reps, similarity)
        lists = work.save(lists.select("value", "cls", "n"), "lists")
        shared = lists.groupBy("value").agg(F.count("*").alias("f")).filter(F.col("f") > SMALL_LIST).select("value")
        shared = work.save(shared, "shared")
        near = _estimated(_neighbours(lists.join(shared, "value", "left_anti"), reps), reps, similarity, k)
        swept = _swept(lists.join(shared, "value", "left_semi"), reps, work, similarity, k)
        pairs = work.save(near.unionByName(swept).distinct(), "pairs")
        work.drop("own-large")
        # Full sets, of those classes only that stand in some list with another class.
        busy = lists.groupBy("value").agg(F.count("*").alias("f")).filter("f > 1").select("value")
        wanted = lists.join(busy, "value", "left_semi").select("cls").distinct()
        holder = light.join(wanted, "cls").groupBy("cls").agg(F.min("id").alias("id"))
        holder = work.save(holder, "holder")
        sets = work.save(_sets(base, holder, n), "sets")
        links = work.save(_verified(pairs, sets, percent), "links")
        roots = work.save(components(links, work, "round-a"), "roots-a")
        members = (
            lists.join(roots, "cls", "left").select("value", "cls", "n", F.coalesce("root", "cls").alias("root"))
        )
        members = work.save(members, "members")
        split = work.save(_split(members), "split")
        crowded = members.join(split.filter(F.col("size") > SMALL_LIST), "value", "left_semi")
        rare = work.save(_rare_lists(crowded, sets, percent), "rare")
        rare_split = work.save(_split(rare), "rare-split")
        large = rare.join(rare_split.filter(F.col("size") > SMALL_LIST), "value", "left_semi")
        small = members.join(split.filter(F.col("size") <= SMALL_LIST), "value", "left_semi").drop("n").unionByName(
            rare.join(rare_split.filter(F.col("size") <= SMALL_LIST), "value", "left_semi").drop("n")
        )
        other = small.select("value", F.col("cls").alias("cls2"), F.col("root").alias("root2"))
        across = small.join(other, "value").filter("cls < cls2 and root <> root2")
        across = across.select(F.col("cls").alias("a"), F.col("cls2").alias("b")).distinct()
        across = across.join(pairs, ["a", "b"], "left_anti")
        across = _estimated(across, reps, similarity, k)
        more = _verified(work.save(across, "across"), sets, percent).unionByName(_wide_links(_by_size(large, similarity), sets, percent))
        final = work.save(components(work.save(links.unionByName(more), "all-links"), work, "round-b"), "roots")
        classes = light.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("first"))
        rooted = classes.join(final, "cls", "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
        rooted = work.save(rooted, "rooted")
        best = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        named = work.save(rooted.join(best, "root").select("cls", "root", "component_id"), "named")
        work.keep("named")
    alone = light.filter("cls is null").withColumns({"root": F.col("cls"), "component_id": F.col("id")})
    grouped = light.filter("cls is not null").join(named, "cls")
    figures = [F.col("id").alias(id_col), "cls", "root", F.col("n").alias("n_shingles"), "component_id", "text_hash"]
    return grouped.select(*figures).unionByName(alone.select(*figures))


def _sets(base: DataFrame, holder: DataFrame, n: int) -> DataFrame:
    """(cls, shingles) of the wanted classes, from one of the documents that hold each."""
    ids = holder.select(F.col("id").alias("wanted")).distinct()
    texts = base.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t.as_py(), n) for t in batch.column(0)]
            classes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), _lists(sets)], names=["cls", "shingles"])

    made = texts.select("text").mapInArrow(run, "cls binary, shingles array<bigint>")
    return made.join(holder.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def drop_near_duplicates(docs: DataFrame, percent: int = 80, n: int = SHINGLE, k: int = K) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest ``doc_id``.

    Texts without words are kept, all of them. Of rows that repeat the smallest id of a group, one stays. Columns
    and their order stay as they are.
    """
    groups = group_near_duplicates(docs, percent, n, k)
    chosen = (
        groups.filter(F.col("cls").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
        .select("kept")
    )
    # The texts are not cut into words again: a row is known by its id and the hash of its text.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("hash"),
        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("has_word"),
    )
    same = F.col("id").eqNullSafe(F.col("kept.doc_id")) & (F.col("hash") == F.col("kept.text_hash"))
    stay = rows.filter("has_word").join(chosen, same, "left_semi").dropDuplicates(["id", "hash"])
    return stay.unionByName(rows.filter(~F.col("has_word"))).select("row.*")
