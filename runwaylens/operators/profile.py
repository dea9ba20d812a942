"""Profiles of a table: missing values, copies, frequencies, distributions and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runwaylens.functions import clip, lookup, month_label
from runwaylens.schema import (
    CANCELLATION_LABELS,
    HISTOGRAM_BINS,
    HISTOGRAM_CLIP,
    NUMBER_COLUMNS,
)
from runwaylens.sources.scratch import Workspace

QUARTILES = [0.25, 0.5, 0.75]
# Distinct values of all columns that one range holds, about.
PART_VALUES = 200_000
SKETCH_ACCURACY = 10000


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, most missing first; one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("all_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    pct = F.round(F.try_divide(F.col("null_count") * 100.0, F.col("all_rows")), 2)
    return (
        counts.unpivot(["all_rows"], df.columns, "column", "null_count")
        .select("column", "null_count", pct.alias("null_pct"))
        .orderBy(F.desc("null_pct"), F.desc("null_count"), "column")
    )


def copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies; combined inside each task before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes that stand for a row: equal for equal rows, and as good as never for others.

    Which columns are NULL is hashed first, since the hash of the values passes over NULL.
    """
    gaps = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in columns])
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(seed), gaps, *values).alias(name) for seed, name in ((1, "digest_1"), (2, "digest_2"))]


def digest_copies(df: DataFrame, **figures: Column) -> DataFrame:
    """``copies`` by digest: 16 bytes a row are shuffled, however wide the rows, and sums of any ``figures``."""
    made = df.select(*row_digest(df.columns), *[f.alias(name) for name, f in figures.items()])
    sums = [F.sum(name).alias(name) for name in figures]
    return made.groupBy("digest_1", "digest_2").agg(F.count(F.lit(1)).alias("copies"), *sums)


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows (NULL equals NULL), and their share."""
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return (
        digest_copies(df)
        .agg(total.alias("rows"), (total - F.count(F.lit(1))).alias("duplicates"))
        .withColumn("duplicate_pct", F.round(F.try_divide(F.col("duplicates") * 100.0, F.col("rows")), 3))
    )


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Frequency of each value that is not missing, by count or by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("count"), column)


def cancellation_causes(df: DataFrame) -> DataFrame:
    """Frequency of the cancellation reasons by name; unknown codes are left out."""
    named = df.select(lookup("cancellation_code", CANCELLATION_LABELS).alias("cause"))
    return value_counts(named, "cause")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(at, value, n) for the non-missing values of the column at each place; equal values meet inside each task first."""
    places = [str(i) for i in range(len(columns))]
    return (
        df.select(*[F.col(f"`{c}`").cast("double").alias(i) for i, c in zip(places, columns, strict=True)])
        .unpivot([], places, "at", "value")
        .where("value IS NOT NULL")
        .groupBy("at", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("at", F.col("at").cast("int"))
    )


def in_ranges(freq: DataFrame, work: Workspace, part_values: int = PART_VALUES) -> DataFrame:
    """Stored frequencies with ``part``, the number of a range of neighbouring values of all columns.

    The ranges follow the values: Spark samples them and cuts where equal numbers of them lie, so neither clusters nor
    far outliers put many into one part. As few distinct values as one range holds are one part as they are.
    """
    parts = -(-freq.count() // part_values)
    if parts <= 1:
        return freq.withColumn("part", F.lit(0))
    ranged = freq.repartitionByRange(parts, "at", "value").withColumn("part", F.spark_partition_id())
    return work.save(ranged, "ranged")


def frequency_stats(ranged: DataFrame, probabilities: Sequence[float] = tuple(QUARTILES)) -> DataFrame:
    """One row per column place: count, mean, std (n - 1), min, max and interpolated quantiles ``q``.

    Every part is walked in order as a sorted running count that can spill; the rows of the parts before it are added.
    Offsets and means have one row for each part and column.
    """
    parts = ranged.groupBy("at", "part").agg(
        F.sum("n").alias("rows"), F.sum(F.col("value") * F.col("n")).alias("total"), F.min("value").alias("low")
    )
    column = Window.partitionBy("at")
    before = F.sum("rows").over(column.orderBy("low")) - F.col("rows")
    whole = F.sum("rows").over(column)
    heads = parts.select(
        "at", "part", before.alias("before"), whole.alias("all_rows"), (F.sum("total").over(column) / whole).alias("centre")
    )
    inside = Window.partitionBy("at", "part").orderBy("value")
    walked = ranged.join(F.broadcast(heads), ["at", "part"]).withColumn("end", F.col("before") + F.sum("n").over(inside))
    off = F.col("value") - F.col("centre")
    last = F.col("all_rows") - 1

    def quantile(p: float) -> Column:
        def at(position: Column) -> Column:
            held = (F.col("end") - F.col("n") <= position) & (position < F.col("end"))
            return F.max(F.when(held, F.col("value")))

        place = last * F.lit(p)
        lo, hi = at(F.floor(place)), at(F.ceil(place))
        share = F.first(place - F.floor(place))
        return lo + (hi - lo) * share

    return walked.groupBy("at").agg(
        F.sum("n").alias("count"),
        F.first("centre").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.col("n") * off * off), F.sum("n") - 1)).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.array(*[quantile(p) for p in probabilities]).alias("q"),
    )


DESCRIBED = "column string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"


def described(stats: DataFrame) -> DataFrame:
    """Figures by column name in the layout of ``describe``."""
    quartiles = [F.round(F.col("q")[i], 2).alias(f"p{round(p * 100)}") for i, p in enumerate(QUARTILES)]
    rounded = {c: F.round(c, 2).alias(c) for c in ("mean", "std", "min", "max")}
    return stats.select("column", "count", rounded["mean"], rounded["std"], rounded["min"], *quartiles, rounded["max"])


def describe_frequencies(freq: DataFrame, columns: Sequence[str], work: Workspace) -> DataFrame:
    """``describe`` from stored value frequencies; the figures, one row per column, are worked out at once."""
    spark = freq.sparkSession
    ranged = in_ranges(freq, work)
    names = F.broadcast(spark.createDataFrame(list(enumerate(columns)), "at int, column string"))
    figures = described(frequency_stats(ranged).join(names, "at")).collect()
    return spark.createDataFrame(figures, DESCRIBED)


def describe(df: DataFrame, columns: Sequence[str] = tuple(NUMBER_COLUMNS), exact: bool = True) -> DataFrame:
    """count, mean, std (n - 1), min, quartiles (linear interpolation) and max per column.

    The exact form works on value frequencies: one scan reduces the table to one row per distinct value and column,
    which is written to the shared folder, cut into even ranges and removed at the end. With ``exact=False`` quartiles
    come from mergeable sketches of fixed size, in one pass.
    """
    if exact:
        with Workspace(df.sparkSession, "describe") as work:
            return describe_frequencies(work.save(value_frequencies(df, columns), "frequencies"), columns, work)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    stats = (
        rows.unpivot([], list(columns), "column", "value")
        .where("value IS NOT NULL")
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.percentile_approx("value", QUARTILES, SKETCH_ACCURACY).alias("q"),
            F.max("value").alias("max"),
        )
    )
    return described(stats)


def scalar_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, mean and std of each column, as one row per column, from one pass."""
    aggs = [
        F.struct(
            F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")
        ).alias(c)
        for c in columns
    ]
    long = df.agg(*aggs).unpivot([], list(columns), "column", "s")
    return long.select(
        "column",
        "s.min",
        "s.max",
        F.round("s.mean", 1).alias("mean"),
        F.round("s.std", 1).alias("std"),
    )


def flag_share(df: DataFrame, flag: str = "cancelled") -> DataFrame:
    """Rows with the flag set, their percentage of all rows, and rows with the flag clear."""
    is_set, is_clear = F.count_if(F.col(flag) == 1), F.count_if(F.col(flag) == 0)
    return df.agg(
        is_set.alias("flagged"),
        F.round(F.try_divide(is_set * 100.0, F.count(F.lit(1))), 2).alias("flagged_pct"),
        is_clear.alias("clear"),
    )


def flag_rate_by(df: DataFrame, key: str, flag: str = "cancelled") -> DataFrame:
    """Percentage of set flags per key, highest first."""
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg((F.avg(flag) * 100).alias("flag_pct")).orderBy(F.desc("flag_pct"), key)


def means_by(df: DataFrame, key: str, measures: Sequence[str] = ("dep_delay", "arr_delay")) -> DataFrame:
    """Average of several measures per key, 2 decimals."""
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(*[F.round(F.avg(m), 2).alias(f"avg_{m}") for m in measures])


def means_by_entity(df: DataFrame, key: str = "op_unique_carrier") -> DataFrame:
    return means_by(df, key).orderBy(F.desc_nulls_last("avg_dep_delay"), key)


def means_by_month(df: DataFrame) -> DataFrame:
    return means_by(df, "month").withColumn("month_label", month_label("month")).orderBy("month")


def mean_and_count(df: DataFrame, key: str = "origin", measure: str = "dep_delay") -> DataFrame:
    """Mean and number of non-missing values per key."""
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.avg(measure).alias("mean"), F.count(measure).alias("count"))


def top_by_mean(
    df: DataFrame, key: str = "origin", measure: str = "dep_delay", min_count: int = 1000, n: int = 20
) -> DataFrame:
    """The ``n`` keys with the highest mean among those with at least ``min_count`` values."""
    big = mean_and_count(df, key, measure).where(F.col("count") >= min_count)
    return big.orderBy(F.desc("mean"), key).limit(n)


def top_by_count(df: DataFrame, key: str = "origin", n: int = 20) -> DataFrame:
    return value_counts(df, key).limit(n)


def _histogram_edges(c: str, limits: tuple[float, float], bins: int) -> Column:
    """Aggregate: lower end and bin width of one column."""
    lo, hi = clip(F.min(c), *limits), clip(F.max(c), *limits)
    # A column with a single value gets half a unit on either side.
    flat = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))
    return F.struct((lo - flat).alias("lo"), ((hi + flat - (lo - flat)) / F.lit(bins)).alias("width"))


def histogram(
    df: DataFrame,
    columns: Sequence[str] = ("dep_delay", "arr_delay"),
    limits: tuple[float, float] = HISTOGRAM_CLIP,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Equal bins between the smallest and largest clipped value; the last bin is closed.

    Clipping keeps order, so the ends are the clipped minimum and maximum, and the value
    range needs no second aggregation per bin. Empty bins are listed with 0.
    """
    edges = {c: _histogram_edges(c, limits, bins) for c in columns}
    seen = df.agg(F.struct(*[e.alias(c) for c, e in edges.items()])).scalar()

    def bin_of(c: str) -> Column:
        place = F.floor((clip(c, *limits) - seen[c]["lo"]) / seen[c]["width"])
        return F.when(F.col(c).isNotNull(), F.least(place, F.lit(bins - 1)).cast("int"))

    found = (
        df.select(*[bin_of(c).alias(c) for c in columns])
        .unpivot([], list(columns), "column", "bin")
        .where("bin IS NOT NULL")
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), names)
    edge = F.coalesce(*[F.when(F.col("column") == c, seen[c]) for c in columns])
    return (
        every.join(found, ["column", "bin"], "left")
        .withColumn("edge", edge)
        .select(
            "column",
            "bin",
            F.round(F.col("edge.lo") + F.col("bin") * F.col("edge.width"), 4).alias("bin_start"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


def table_metrics(df: DataFrame, name: str, missing: str = "dep_delay", flag: str = "cancelled") -> DataFrame:
    """(dataset, metric, value): rows, columns, copies, missing measures and set flags; one pass."""
    total = F.coalesce(F.sum("copies"), F.lit(0))
    groups = digest_copies(df, missing=F.col(missing).isNull().cast("long"), flags=F.col(flag).try_cast("double"))
    metrics = {
        "rows": total,
        "columns": F.lit(len(df.columns)),
        "duplicates": total - F.count(F.lit(1)),
        f"missing_{missing}": F.coalesce(F.sum("missing"), F.lit(0)),
        f"total_{flag}": F.coalesce(F.sum("flags"), F.lit(0.0)),
    }
    wide = groups.agg(*[m.cast("double").alias(k) for k, m in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value").select(F.lit(name).alias("dataset"), "metric", "value")


def before_after(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The metrics of both tables side by side."""
    both = table_metrics(raw, "raw").unionByName(table_metrics(cleaned, "cleaned"))
    return both.groupBy("metric").pivot("dataset", ["raw", "cleaned"]).agg(F.max("value"))


def describe_before_after(
    raw: DataFrame, cleaned: DataFrame, columns: Sequence[str] = ("dep_delay", "arr_delay")
) -> DataFrame:
    """``describe`` of both tables, one row per table and column."""
    first = describe(raw, columns).withColumn("dataset", F.lit("raw"))
    return first.unionByName(describe(cleaned, columns).withColumn("dataset", F.lit("cleaned")))
