"""Quality rules: text statistics, fixed limits, and robust multivariate outliers per language and source.

The statistics of a text become a vector. For every language and source the minimum covariance determinant estimate
(the mean and covariance of the half of the vectors that lie closest together) is found by concentration steps from
a median start; a text whose Mahalanobis distance from its group is beyond a limit is rejected. All of it is
DataFrame expressions; a step is one aggregation with a few hundred rows per group, however many texts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runwaylens.sources.scratch import Workspace

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
# Statistics of the vector, with the spread below which differences do not count.
VECTOR = {"x1": 0.15, "x2": 0.10, "x3": 0.40, "x4": 0.25}
NAMES = list(VECTOR)
# Share of a group that the estimate rests on, and concentration steps.
HALF = 0.75
STEPS = 3
# Chi-square of 4 degrees of freedom: median, 97.5 %, and the limit of rejection (one in a million).
MEDIAN, USUAL, LIMIT = 3.357, 11.143, 33.4
# Groups of fewer texts are pooled within their language; pools of fewer reject nothing.
LEAST = 50
BINS = 16


def statistics(docs: DataFrame) -> DataFrame:
    """Every row and column of ``docs`` with word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words (long)."""
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    out = docs.withColumn("__words", words)
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda s: F.btrim(s, F.lit(BLANKS)) != "")
    h = F.transform("__words", lambda w: F.xxhash64(w))
    n = F.size("__words")
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("long"),
            "__lines": lines,
            "__h": h,
        }
    )
    pairs = F.zip_with(F.slice("__h", F.lit(1), F.greatest(n - 2, F.lit(0))), F.slice("__h", F.lit(2), F.greatest(n - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice("__h", F.lit(3), F.greatest(n - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    out = out.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    out = out.withColumn("__w", F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    # Only texts with some window twice pay for the sort.
    twice = F.size(F.array_distinct("__w")) < F.size("__w")
    placed = F.array_sort(F.transform("__w", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn("__s", F.when(twice, placed))
    repeated = F.transform(
        "__s",
        lambda x, i: F.when(
            (F.get("__s", i - 1)["h"] == x["h"]) | (F.get("__s", i + 1)["h"] == x["h"]), x["i"]
        ),
    )
    out = out.withColumn("__p", F.array_sort(F.array_compact(repeated)))
    steps = F.zip_with(F.slice("__p", F.lit(2), F.size("__p")), F.slice("__p", F.lit(1), F.size("__p") - 1), lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("__p") > 0, F.aggregate(steps, F.lit(3), lambda s, x: s + x)).otherwise(0)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return out.drop("__words", "__lines", "__h", "__w", "__s", "__p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def vector() -> dict[str, Column]:
    """Transformed statistics: logarithms of sizes, angles of shares."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    angle = lambda c: F.asin(F.sqrt(F.least(c, F.lit(1.0))))
    return {
        "x1": F.log(F.greatest("word_chars", F.lit(1)) / n),
        "x2": angle(F.col("n_symbols") / n),
        "x3": F.log1p(F.col("n_dup_lines").cast("double")),
        "x4": angle(F.col("n_repeat_words") / n),
    }


def _pairs() -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(NAMES) for b in NAMES[: i + 1]]


def _moments() -> list[Column]:
    return [
        F.count("*").alias("n"),
        *[F.sum(a).alias(f"s_{a}") for a in NAMES],
        *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}{b}") for a, b in _pairs()],
    ]


def _fitted(sums: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of each group from its moments; the least spread is added to the variances."""
    out = sums.select("g", "n", *[(F.col(f"s_{a}") / F.col("n")).alias(f"m_{a}") for a in NAMES], *[f"s_{a}{b}" for a, b in _pairs()])
    for a, b in _pairs():
        v = F.col(f"s_{a}{b}") / F.col("n") - F.col(f"m_{a}") * F.col(f"m_{b}")
        out = out.withColumn(f"v_{a}{b}", F.greatest(v, F.lit(0.0)) + VECTOR[a] ** 2 if a == b else v)
    for i, a in enumerate(NAMES):
        for b in NAMES[:i]:
            k = NAMES.index(b)
            rest = sum((F.col(f"l_{a}{c}") * F.col(f"l_{b}{c}") for c in NAMES[:k]), F.lit(0.0))
            out = out.withColumn(f"l_{a}{b}", (F.col(f"v_{a}{b}") - rest) / F.col(f"l_{b}{b}"))
        rest = sum((F.col(f"l_{a}{c}") * F.col(f"l_{a}{c}") for c in NAMES[:i]), F.lit(0.0))
        out = out.withColumn(f"l_{a}{a}", F.sqrt(F.greatest(F.col(f"v_{a}{a}") - rest, F.lit(VECTOR[a] ** 2))))
    return out.select("g", *[f"m_{a}" for a in NAMES], *[f"l_{a}{b}" for a, b in _pairs()])


def _distances(vectors: DataFrame, fit: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` of every vector from its group, by forward substitution."""
    out = vectors.join(fit, "g")
    for i, a in enumerate(NAMES):
        rest = sum((F.col(f"l_{a}{b}") * F.col(f"y_{b}") for b in NAMES[:i]), F.lit(0.0))
        out = out.withColumn(f"y_{a}", (F.col(a) - F.col(f"m_{a}") - rest) / F.col(f"l_{a}{a}"))
    return out.withColumn("d2", sum((F.col(f"y_{a}") ** 2 for a in NAMES), F.lit(0.0))).select(*vectors.columns, "d2")


def _binned(value: Column) -> Column:
    return F.floor(F.log2(F.greatest(value, F.lit(1e-6))) * BINS).cast("int")


def _up_to(binned: DataFrame, share: float) -> DataFrame:
    """Rows of (g, bin, n, ...) up to the bin in which the given share of the group is reached."""
    before = F.sum("n").over(Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy("g"))
    marked = binned.withColumns({"__before": F.coalesce(before, F.lit(0)), "__total": total})
    return marked.filter(F.col("__before") < F.col("__total") * share).drop("__before", "__total")


def _start(vectors: DataFrame) -> DataFrame:
    """Median of every coordinate, with the least spread as a first, diagonal estimate (same columns as a fit)."""
    grid = 256
    long = vectors.select(
        "g", F.explode(F.array(*[F.struct(F.lit(a).alias("k"), F.floor(F.col(a) * grid).cast("int").alias("bin")) for a in NAMES])).alias("e")
    )
    counts = long.groupBy("g", F.col("e.k").alias("k"), F.col("e.bin").alias("bin")).agg(F.count("*").alias("n"))
    # The last bin before half of the group is reached.
    medians = _up_to(counts.withColumn("g", F.struct("g", "k")), 0.5).groupBy("g").agg(F.max("bin").alias("bin"))
    medians = medians.select(F.col("g.g").alias("g"), F.col("g.k").alias("k"), ((F.col("bin") + 0.5) / grid).alias("m"))
    centre = medians.groupBy("g").agg(*[F.max(F.when(F.col("k") == a, F.col("m"))).alias(f"m_{a}") for a in NAMES])
    return centre.select("*", *[F.lit(VECTOR[a] if a == b else 0.0).alias(f"l_{a}{b}") for a, b in _pairs()])


def _fit_below(distances: DataFrame, share: float) -> DataFrame:
    binned = distances.withColumn("bin", _binned(F.col("d2"))).groupBy("g", "bin").agg(*_moments())
    inner = _up_to(binned, share)
    return _fitted(inner.groupBy("g").agg(*[F.sum(c).alias(c) for c in binned.columns if c not in ("g", "bin")]))


def judge(docs: DataFrame, limit: float = LIMIT, work: Workspace | None = None) -> DataFrame:
    """Every row and column of ``docs`` but the text, with the statistics, ``base_failed``, ``distance2`` and ``kept``.

    Texts that fail the fixed limits (fewer than 50 words; over half of the words in repeated windows) are not kept
    and take no part in the estimates. Others are kept unless their squared distance from their group (language and
    source, NULL a value of its own) exceeds ``limit``; in groups that stay below LEAST texts when pooled within
    the language the distance is NULL and nothing is rejected. NULL and empty texts have no words and fail. Ties and
    repeated rows change nothing: the outcome of a row hangs on its vector and its group's counts.
    """
    spark = docs.sparkSession
    stats = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    with Workspace(spark, "quality") as work:
        told = statistics(docs.drop(*stats)).drop("text").withColumns({"base_failed": base_failed(), **vector()})
        told = work.save(told, "statistics")
        work.keep("statistics")
        good = told.filter("not base_failed")
        sizes = good.groupBy("lang", "source").agg(F.count("*").alias("n"))
        small = F.col("n") < LEAST
        pool = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
        named = sizes.withColumn("pool", pool).withColumn("g", F.to_json(F.struct("lang", F.when(~small, F.col("source")).alias("source"), small.alias("pooled"))))
        named = work.save(named.filter(~small | (F.col("pool") >= LEAST)).select(F.col("lang").alias("__l"), F.col("source").alias("__s"), "g"), "groups")
        work.keep("groups")
        grouped = F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s"))
        vectors = work.save(good.join(named, grouped).select("g", *NAMES), "vectors")
        fit = work.save(_start(vectors), "fit0")
        for step in range(1, STEPS + 1):
            fit = work.save(_fit_below(_distances(vectors, fit), HALF), f"fit{step}")
        # Scale so that the median distance is that of a normal vector, then use all that are not far.
        distances = _distances(vectors, fit).withColumn("bin", _binned(F.col("d2")))
        counts = distances.groupBy("g", "bin").agg(F.count("*").alias("n"))
        middle = _up_to(counts, 0.5).groupBy("g").agg(F.max("bin").alias("bin"))
        scale = middle.select("g", F.greatest(F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS) / MEDIAN, F.lit(1.0)).alias("scale"))
        scaled = work.save(scale, "scale")
        near = distances.join(scaled, "g").filter(F.col("d2") / F.col("scale") <= USUAL)
        final = _fitted(near.groupBy("g").agg(*_moments()))
        final = work.save(final, "fit")
        work.keep("fit")
    judged = _distances(told.filter("not base_failed").join(named, grouped).drop("__l", "__s"), final)
    judged = judged.withColumn("distance2", F.col("d2")).drop("d2", "g")
    rest = told.filter("base_failed").unionByName(told.filter("not base_failed").join(named, grouped, "left_anti"))
    both = judged.unionByName(rest.withColumn("distance2", F.lit(None).cast("double")))
    kept = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= limit)
    return both.withColumn("kept", kept).drop(*NAMES)
