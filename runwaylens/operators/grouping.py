"""Grouped statistics of a fact table: per period, per delay band, per cause, and at two grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runwaylens.functions import delay_band, flag_rate, mean_from, present
from runwaylens.operators.joins import shared
from runwaylens.schema import FLIGHT_ROLES, Roles

NO_CAUSE = "none"
TOP_CAUSES = 3


def period_stats(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Count, min/max/average of the second measure and flag rate per entity, site and period."""
    keys = [F.col(roles.entity).alias("carrier"), F.col(roles.site).alias("origin"), F.col(roles.period).alias("month")]
    m = roles.second_measure
    return (
        df.where(present(roles.entity, roles.site, roles.period))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.round(F.min(m), 2).alias("min_arr_delay"),
            F.round(F.max(m), 2).alias("max_arr_delay"),
            F.round(F.avg(m), 2).alias("avg_arr_delay"),
            flag_rate(roles.flag).alias("cancel_rate"),
        )
    )


def sorted_periods(periods: Column, as_text: bool = True) -> Column:
    """Distinct periods in their own order; joined only after sorting, so 9 comes before 10."""
    ordered = F.array_sort(periods)
    return F.array_join(ordered.cast("array<string>"), ",") if as_text else ordered


def with_active_periods(stats: DataFrame, as_text: bool = True) -> DataFrame:
    """Attach the periods in which each (carrier, origin) occurs.

    A window over the aggregated rows, which hold one row per period, so neither a
    second scan nor a join is needed.
    """
    pair = Window.partitionBy("carrier", "origin")
    return stats.withColumn("months_active", sorted_periods(F.collect_set("month").over(pair), as_text))


def active_periods(stats: DataFrame, as_text: bool = True) -> DataFrame:
    """One row per (carrier, origin) with its periods."""
    return stats.groupBy("carrier", "origin").agg(
        sorted_periods(F.collect_set("month"), as_text).alias("months_active")
    )


def band_stats(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Count and averages per site, period and delay band; rows without a measure have no band."""
    return (
        df.where(present(roles.site, roles.period, roles.measure))
        .groupBy(
            F.col(roles.site).alias("origin"),
            F.col(roles.period).alias("month"),
            delay_band(roles.measure).alias("delay_band"),
        )
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.round(F.avg(roles.measure), 2).alias("avg_dep"),
            F.round(F.avg(roles.second_measure), 2).alias("avg_arr"),
        )
    )


def band_cells(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Per site, period and band: count, averages, and sums and counts of the positive minutes of every cause.

    Rows without a band, site or period stay as groups of their own, since their causes count.
    """
    positive = {label: F.when(F.col(c) > 0, F.col(c)) for label, c in roles.causes.items()}
    return df.groupBy(
        F.col(roles.site).alias("origin"),
        F.col(roles.period).alias("month"),
        delay_band(roles.measure).alias("delay_band"),
    ).agg(
        F.count(F.lit(1)).alias("num_flights"),
        F.round(F.avg(roles.measure), 2).alias("avg_dep"),
        F.round(F.avg(roles.second_measure), 2).alias("avg_arr"),
        *[F.sum(v).alias(f"sum_{label}") for label, v in positive.items()],
        *[F.count(v).alias(f"n_{label}") for label, v in positive.items()],
    )


def cell_cause_means(cells: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """``cause_means`` from the cells, without a further scan."""
    means = [mean_from(F.sum(f"sum_{label}"), F.sum(f"n_{label}")).alias(label) for label in roles.causes]
    wide = cells.groupBy("origin", "month").agg(*means)
    return wide.unpivot(["origin", "month"], list(roles.causes), "cause", "avg_minutes").where(present("avg_minutes"))


def cause_rows(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """One row per fact row and cause with positive minutes."""
    named = df.select(
        F.col(roles.site).alias("origin"),
        F.col(roles.period).alias("month"),
        *[F.col(c).alias(label) for label, c in roles.causes.items()],
    )
    return named.unpivot(["origin", "month"], list(roles.causes), "cause", "minutes").where("minutes > 0")


def cause_means_wide(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Average positive minutes of every cause per site and period, in one pass."""
    means = [F.avg(F.when(F.col(c) > 0, F.col(c))).alias(label) for label, c in roles.causes.items()]
    return df.groupBy(F.col(roles.site).alias("origin"), F.col(roles.period).alias("month")).agg(*means)


def cause_means(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Same as rows (origin, month, cause, avg_minutes); only the small aggregate is unpivoted."""
    wide = cause_means_wide(df, roles)
    return wide.unpivot(["origin", "month"], list(roles.causes), "cause", "avg_minutes").where(present("avg_minutes"))


def cause_means_union(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Same again as a union of one branch per cause, all from one aggregate."""
    wide = shared(cause_means_wide(df, roles))
    parts = [
        wide.where(present(label)).select("origin", "month", F.lit(label).alias("cause"), F.col(label).alias("avg_minutes"))
        for label in roles.causes
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rank_causes(means: DataFrame, top: int = TOP_CAUSES) -> DataFrame:
    """Position of each cause by unrounded average, largest first; equal averages go by name."""
    best = Window.partitionBy("origin", "month").orderBy(F.desc("avg_minutes"), "cause")
    return means.withColumn("rnk", F.row_number().over(best)).where(F.col("rnk") <= top)


def pivot_causes(ranked: DataFrame, top: int = TOP_CAUSES) -> DataFrame:
    """Ranks 1..top as columns, NULL where there are fewer causes."""
    picks = [F.max(F.when(F.col("rnk") == k, F.col("cause"))).alias(f"top_cause_{k}") for k in range(1, top + 1)]
    return ranked.groupBy("origin", "month").agg(*picks)


def pad_causes(df: DataFrame, top: int = TOP_CAUSES) -> DataFrame:
    return df.fillna(NO_CAUSE, subset=[f"top_cause_{k}" for k in range(1, top + 1)])


def top_cause_columns(means: dict[str, Column], top: int = TOP_CAUSES) -> list[Column]:
    """Names of the largest means of one row, padded; the causes are columns, so no window is needed."""
    pairs = F.array(*[F.struct((-m).alias("order"), F.lit(label).alias("cause")) for label, m in means.items()])
    best = F.array_sort(F.filter(pairs, lambda p: p["order"].isNotNull()))
    return [
        F.coalesce(F.get(best, F.lit(k - 1))["cause"], F.lit(NO_CAUSE)).alias(f"top_cause_{k}")
        for k in range(1, top + 1)
    ]


def two_grain_stats(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Totals per (site, entity) and per site.

    The table is aggregated once at the fine grain; the grouping sets then expand only
    the aggregated rows. ``grain`` is 'carrier' or 'airport'.
    """
    fine = (
        df.where(present(roles.site, roles.entity))
        .groupBy(F.col(roles.site).alias("origin"), F.col(roles.entity).alias("carrier"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(roles.measure).alias("dep_sum"),
            F.count(roles.measure).alias("dep_n"),
        )
    )
    sets = [[F.col("origin"), F.col("carrier")], [F.col("origin")]]
    both = fine.groupingSets(sets, "origin", "carrier").agg(
        F.grouping_id().alias("level"),
        F.sum("n").alias("num_flights"),
        F.sum("dep_sum").alias("dep_sum"),
        F.sum("dep_n").alias("dep_n"),
    )
    return both.select(
        "origin",
        F.when(F.col("level") == 0, "carrier").otherwise("airport").alias("grain"),
        "carrier",
        "num_flights",
        F.round(mean_from("dep_sum", "dep_n"), 4).alias("avg_dep_delay"),
    )
