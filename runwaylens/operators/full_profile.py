"""Every table of a profile from three scans of the facts: cells of all keys, value frequencies, row digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runwaylens.functions import clip, lookup, mean_from, month_label
from runwaylens.operators.profile import describe_frequencies, duplicate_profile, value_frequencies
from runwaylens.schema import CANCELLATION_LABELS, HISTOGRAM_BINS, HISTOGRAM_CLIP, NUMBER_COLUMNS
from runwaylens.sources.scratch import Workspace, new_folder, stored_at

KEYS = ["op_unique_carrier", "origin", "month", "cancelled", "cancellation_code"]
MEASURES = ["dep_delay", "arr_delay"]


def key_cells(df: DataFrame, keys: Sequence[str] = tuple(KEYS), measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Per combination of keys: rows, sum and number of every measure, and NULLs of every column of the table.

    Combined inside each task, so a combination that holds a third of all rows is one row per task. All tables by key
    are sums over these rows.
    """
    sums = [F.sum(m).alias(f"sum_{m}") for m in measures] + [F.count(m).alias(f"n_{m}") for m in measures]
    gaps = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sums, *gaps)


def cell_nulls(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``null_profile`` from cells."""
    total = F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows")
    counts = cells.agg(total, *[F.coalesce(F.sum(f"null_{i}"), F.lit(0)).alias(c) for i, c in enumerate(columns)])
    pct = F.round(F.try_divide(F.col("null_count") * 100.0, F.col("all_rows")), 2)
    long = counts.unpivot(["all_rows"], list(columns), "column", "null_count")
    return long.select("column", "null_count", pct.alias("null_pct")).orderBy(
        F.desc("null_pct"), F.desc("null_count"), "column"
    )


def cell_counts(cells: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """``value_counts`` from cells."""
    counts = cells.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("rows").alias("count"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("count"), column)


def cell_means(cells: DataFrame, key: str, digits: int | None = 2) -> DataFrame:
    """``means_by`` from cells."""

    def mean(m: str) -> Column:
        value = mean_from(F.sum(f"sum_{m}"), F.sum(f"n_{m}"))
        return (F.round(value, digits) if digits is not None else value).alias(f"avg_{m}")

    return cells.where(F.col(key).isNotNull()).groupBy(key).agg(*[mean(m) for m in MEASURES])


def cell_flag_share(cells: DataFrame, flag: str = "cancelled") -> DataFrame:
    """``flag_share`` from cells."""

    def rows(condition: Column | None = None) -> Column:
        return F.coalesce(F.sum("rows" if condition is None else F.when(condition, F.col("rows"))), F.lit(0))

    is_set = rows(F.col(flag) == 1)
    pct = F.round(F.try_divide(is_set * 100.0, rows()), 2)
    return cells.agg(is_set.alias("flagged"), pct.alias("flagged_pct"), rows(F.col(flag) == 0).alias("clear"))


def cell_flag_rate(cells: DataFrame, key: str, flag: str = "cancelled") -> DataFrame:
    """``flag_rate_by`` from cells."""
    known = F.when(F.col(flag).isNotNull(), F.col("rows"))
    rate = mean_from(F.sum(F.col(flag) * F.col("rows")), F.sum(known)) * 100
    return cells.where(F.col(key).isNotNull()).groupBy(key).agg(rate.alias("flag_pct")).orderBy(F.desc("flag_pct"), key)


def cell_top_means(cells: DataFrame, key: str = "origin", measure: str = "dep_delay", min_count: int = 1000, n: int = 20) -> DataFrame:
    """``top_by_mean`` from cells."""
    total = F.sum(f"n_{measure}")
    means = cells.where(F.col(key).isNotNull()).groupBy(key).agg(mean_from(F.sum(f"sum_{measure}"), total).alias("mean"), total.alias("count"))
    return means.where(F.col("count") >= min_count).orderBy(F.desc("mean"), key).limit(n)


def frequency_histogram(
    freq: DataFrame, at: dict[str, int], limits: tuple[float, float] = HISTOGRAM_CLIP, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """``histogram`` from value frequencies; ``at`` gives the place of each column among these."""
    spark = freq.sparkSession
    names = F.broadcast(spark.createDataFrame([(i, c) for c, i in at.items()], "at int, column string"))
    values = freq.join(names, "at").select("column", clip("value", *limits).alias("value"), "n")
    ends = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    # One row for each column.
    edges = F.broadcast(ends.select("column", (F.col("lo") - flat).alias("lo"), ((F.col("hi") + flat - (F.col("lo") - flat)) / F.lit(bins)).alias("width")))
    place = F.floor((F.col("value") - F.col("lo")) / F.col("width"))
    found = values.join(edges, "column").groupBy("column", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    found = found.agg(F.sum("n").alias("count"))
    every = spark.createDataFrame([(c, b) for c in at for b in range(bins)], "column string, bin int")
    start = F.round(F.col("lo") + F.col("bin") * F.col("width"), 4)
    return every.join(found, ["column", "bin"], "left").join(edges, "column", "left").select(
        "column", "bin", start.alias("bin_start"), F.coalesce("count", F.lit(0)).alias("count")
    )


def full_profile(df: DataFrame) -> dict[str, DataFrame]:
    """All tables of a profile of a fact table by name, each as the function of that kind gives it.

    Three scans, however many tables there are: cells of the keys and value frequencies are written to the shared
    folder, and copies are counted by digest. The cells and frequencies stay there for the tables that read them.
    """
    spark = df.sparkSession
    root = new_folder(spark, "profile")
    cells = stored_at(key_cells(df), f"{root}/cells")
    freq = stored_at(value_frequencies(df, NUMBER_COLUMNS), f"{root}/frequencies")
    with Workspace(spark, "describe") as work:
        described = describe_frequencies(freq, NUMBER_COLUMNS, work)
    by_carrier = cell_means(cells, "op_unique_carrier").orderBy(F.desc_nulls_last("avg_dep_delay"), "op_unique_carrier")
    by_month = cell_means(cells, "month").withColumn("month_label", month_label("month")).orderBy("month")
    causes = cells.select("rows", lookup("cancellation_code", CANCELLATION_LABELS).alias("cause"))
    return {
        "nulls": cell_nulls(cells, df.columns),
        "duplicates": duplicate_profile(df),
        "by_month": cell_counts(cells, "month", by_value=True),
        "by_carrier": cell_counts(cells, "op_unique_carrier"),
        "histogram": frequency_histogram(freq, {c: NUMBER_COLUMNS.index(c) for c in MEASURES}),
        "cancelled": cell_flag_share(cells),
        "cancel_causes": cell_counts(causes, "cause"),
        "cancel_rate": cell_flag_rate(cells, "op_unique_carrier"),
        "delay_by_carrier": by_carrier,
        "delay_by_month": by_month,
        "top_by_count": cell_counts(cells, "origin").limit(20),
        "top_by_delay": cell_top_means(cells),
        "describe": described,
    }
