"""Comparisons over a log of timed runs.

Group figures (slowest, fastest run) are aggregated and joined back instead of computed
in a window, so a group that holds most of the log is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runwaylens.functions import position_in, slowdown, speedup_tier
from runwaylens.operators.joins import same_keys
from runwaylens.schema import FULL_LABEL, RUN_KEY, SAMPLE_ORDER


def with_group_figures(df: DataFrame, keys: Sequence[str], **figures: Column) -> DataFrame:
    """Attach aggregates of each group to its rows; NULL keys form a group too."""
    names = [f"group_{k}" for k in keys]
    groups = df.groupBy(*[F.col(k).alias(name) for k, name in zip(keys, names)]).agg(
        *[c.alias(name) for name, c in figures.items()]
    )
    return df.join(groups, same_keys(keys, names)).drop(*names)


def full_runs(runs: DataFrame) -> DataFrame:
    """Runs on the whole data set; expects the log with its default label filled in."""
    return runs.where(F.col("notes") == FULL_LABEL)


def first_by(value: str, order: str = "timestamp") -> Column:
    """Aggregate: the earliest value of the group.

    Rows without a time come last; rows of the same time go by their key and the value.
    """
    return F.min_by(value, F.struct(F.col(order).isNull(), F.col(order), *RUN_KEY, value))


def elapsed_pivot(runs: DataFrame, technologies: Sequence[str]) -> DataFrame:
    """Analysis rows by technology columns, first elapsed time; missing combinations are NULL."""
    return full_runs(runs).groupBy("analysis").pivot("technology", list(technologies)).agg(first_by("elapsed_sec"))


def elapsed_matrix(runs: DataFrame, analyses: Sequence[str]) -> DataFrame:
    """Technology rows by analysis columns, first elapsed time."""
    return full_runs(runs).groupBy("technology").pivot("analysis", list(analyses)).agg(first_by("elapsed_sec"))


def speedups(runs: DataFrame) -> DataFrame:
    """How many times faster each full run is than the slowest one of its analysis and environment."""
    rows = with_group_figures(full_runs(runs), ["analysis", "environment"], slowest=F.max("elapsed_sec"))
    return rows.select(
        "analysis", "technology", "environment", "elapsed_sec", F.try_divide("slowest", "elapsed_sec").alias("speedup")
    )


def throughput(runs: DataFrame) -> DataFrame:
    """Thousand rows per second of every full run."""
    rate = F.try_divide(F.col("input_rows"), F.col("elapsed_sec"))
    return full_runs(runs).select(
        "analysis", "technology", "environment", "input_rows", "elapsed_sec", (rate / 1000).alias("throughput_k")
    )


def fixed_variable(runs: DataFrame, technology: str, share: float = 0.9) -> DataFrame:
    """Fixed cost (a share of the fastest run of the analysis and environment) and the rest of each run."""
    rows = with_group_figures(
        runs.where(F.col("technology") == technology), ["analysis", "environment"], fastest=F.min("elapsed_sec")
    )
    fixed = F.col("fastest") * F.lit(share)
    return rows.select(
        "analysis",
        "environment",
        "notes",
        "sample_order",
        "elapsed_sec",
        fixed.alias("fixed_sec"),
        F.greatest(F.col("elapsed_sec") - fixed, F.lit(0.0)).alias("variable_sec"),
    )


def scalability(runs: DataFrame) -> DataFrame:
    """Time against size: million rows and elapsed seconds of each run, in size order."""
    return runs.select(
        "analysis",
        "technology",
        "environment",
        "notes",
        "sample_order",
        (F.col("input_rows") / F.lit(1e6)).alias("million_rows"),
        "elapsed_sec",
    ).orderBy("analysis", "technology", "environment", F.asc_nulls_last("sample_order"), "notes")


def compare_environments(runs: DataFrame, base: str = "local", other: str = "cluster") -> DataFrame:
    """Full runs of two environments side by side with their ratio, its class, and the slowdown."""
    keys = ["analysis", "technology"]

    def side(env: str) -> DataFrame:
        part = full_runs(runs).where(F.col("environment") == env)
        return part.groupBy(*keys).agg(first_by("elapsed_sec").alias(f"{env}_sec"))

    ratio = F.round(F.try_divide(f"{base}_sec", f"{other}_sec"), 2)
    return (
        side(base)
        .join(side(other), keys, "full")
        .withColumn("speedup", ratio)
        .withColumn("tier", speedup_tier("speedup"))
        .withColumn("times_slower", slowdown("speedup"))
    )


def compare_summary(compared: DataFrame) -> DataFrame:
    """Mean ratio, and the best and the worst combination; equal ratios go by name."""
    who = F.struct("analysis", "technology")
    valid = compared.where("speedup IS NOT NULL")
    best = F.max_by(who, F.struct("speedup", "analysis", "technology"))
    worst = F.min_by(who, F.struct("speedup", "analysis", "technology"))
    return valid.agg(
        F.round(F.avg("speedup"), 2).alias("mean_speedup"),
        F.max("speedup").alias("best_speedup"),
        best["analysis"].alias("best_analysis"),
        best["technology"].alias("best_technology"),
        F.min("speedup").alias("worst_speedup"),
        worst["analysis"].alias("worst_analysis"),
        worst["technology"].alias("worst_technology"),
    )


def format_sizes(runs: DataFrame, order: Sequence[str] = tuple(SAMPLE_ORDER)) -> DataFrame:
    """CSV and Parquet size of the labels that both formats have, with their ratio, in size order."""

    def sizes(suffix: str) -> DataFrame:
        part = runs.where(F.col("input_file").endswith("." + suffix))
        return part.groupBy("notes").agg(first_by("input_size_mb").alias(f"{suffix}_mb"))

    both = sizes("csv").join(sizes("parquet"), "notes")
    ratio = F.when(F.col("parquet_mb") > 0, F.col("csv_mb") / F.col("parquet_mb"))
    return both.withColumn("ratio", ratio).orderBy(position_in("notes", order, missing=99), "notes")


def combined_log(*logs: tuple[DataFrame, str]) -> DataFrame:
    """Stack several logs, each tagged with its environment."""
    out = None
    for runs, environment in logs:
        part = runs.withColumn("environment", F.lit(environment))
        out = part if out is None else out.unionByName(part)
    return out


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str] = tuple(RUN_KEY)) -> DataFrame:
    """Old log with each new row added, or put in place of one old row with the same key.

    Among several new rows of one key the latest wins (no time is earliest; equal times go by the other columns).
    Of several old rows with that key the earliest is replaced and the rest stay. ``action`` tells kept, added and
    replaced rows apart. Old rows that no new row concerns are not touched, whatever they repeat.
    """
    rest = [c for c in old.columns if c not in key]
    order = F.struct(F.col("timestamp").isNotNull(), "timestamp", *[c for c in rest if c != "timestamp"])
    latest = new.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("row"))
    names = [f"new_{k}" for k in key]
    changed = latest.select(*[F.col(k).alias(n) for k, n in zip(key, names)])
    untouched = old.join(changed, same_keys(key, names), "left_anti").withColumn("action", F.lit("kept"))
    # Equal old rows are counted, so that one of them can be taken away.
    met = old.join(changed, same_keys(key, names), "left_semi").groupBy(*old.columns).agg(F.count(F.lit(1)).alias("n"))
    first_key = F.struct(F.col("timestamp").isNull(), F.struct(*rest))
    earliest = met.groupBy(*[F.col(k).alias(n) for k, n in zip(key, names)]).agg(F.min(first_key).alias("first"))
    matched = met.join(earliest, same_keys(key, names))
    left = F.col("n") - first_key.eqNullSafe(F.col("first")).cast("long")
    others = matched.withColumn("copy", F.explode(F.array_repeat(F.lit(1), left.cast("int"))))
    others = others.select(*old.columns, F.lit("kept").alias("action"))
    placed = latest.join(earliest, same_keys(key, names), "left")
    action = F.when(F.col("first").isNull(), "added").otherwise("replaced")
    columns = [F.col(c) if c in key else F.col(f"row.{c}") for c in old.columns]
    return untouched.unionByName(others).unionByName(placed.select(*columns, action.alias("action")))
