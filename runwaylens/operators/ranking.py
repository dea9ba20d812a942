"""Ranks of members inside their group, and differences to the group mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runwaylens.functions import flag_rate, mean_from, present
from runwaylens.operators.joins import shared
from runwaylens.schema import FLIGHT_ROLES, Roles
from runwaylens.sources.scratch import stored


def member_totals(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Counts and sums per (site, entity); rows without an entity stay, as a group of their own."""
    return (
        df.where(present(roles.site))
        .groupBy(F.col(roles.site).alias("origin"), F.col(roles.entity).alias("carrier"))
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.sum(roles.measure).alias("dep_sum"),
            F.count(roles.measure).alias("dep_n"),
            F.round(F.avg(roles.second_measure), 4).alias("avg_arr_delay"),
            flag_rate(roles.flag).alias("cancel_rate"),
        )
    )


def member_stats(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Report figures per (site, entity), without rows that lack an entity."""
    return member_figures(member_totals(df, roles))


def member_figures(totals: DataFrame) -> DataFrame:
    """``member_stats`` from member totals."""
    return (
        totals.where("carrier IS NOT NULL")
        .withColumn("avg_dep_delay", F.round(mean_from("dep_sum", "dep_n"), 4))
        .select("origin", "carrier", "num_flights", "avg_dep_delay", "avg_arr_delay", "cancel_rate")
    )


def site_means(df: DataFrame, roles: Roles = FLIGHT_ROLES, only_valid: bool = False) -> DataFrame:
    """Average measure per site over all rows; ``only_valid`` leaves out sites without any value."""
    rows = df.where(present(roles.site))
    if only_valid:
        rows = rows.where(present(roles.measure))
    return rows.groupBy(F.col(roles.site).alias("origin")).agg(
        F.round(F.avg(roles.measure), 4).alias("avg_dep_airport")
    )


def with_site_mean(totals: DataFrame) -> DataFrame:
    """Attach the site mean to member totals by a window over the totals.

    Members without an entity count in the mean, so they must still be present here.
    """
    site = Window.partitionBy("origin")
    mean = mean_from(F.sum("dep_sum").over(site), F.sum("dep_n").over(site))
    return totals.withColumn("avg_dep_airport", F.round(mean, 4))


def total_means(totals: DataFrame, only_valid: bool = False) -> DataFrame:
    """``site_means`` from totals of any finer grain."""
    means = totals.groupBy("origin").agg(
        F.round(mean_from(F.sum("dep_sum"), F.sum("dep_n")), 4).alias("avg_dep_airport"), F.sum("dep_n").alias("dep_n")
    )
    return (means.where("dep_n > 0") if only_valid else means).select("origin", "avg_dep_airport")


def with_site_mean_joined(totals: DataFrame) -> DataFrame:
    """Same by aggregate and join, for sites with so many members that one task should not hold a site."""
    return totals.join(total_means(totals), "origin")


def members_with_site_mean(df: DataFrame, roles: Roles = FLIGHT_ROLES, only_valid: bool = False) -> DataFrame:
    """``member_stats`` joined with the mean of their site; both come from one aggregate over the facts."""
    totals = shared(member_totals(df, roles))
    return member_figures(totals).join(total_means(totals, only_valid), "origin")


def labelled_counts_with_site_mean(
    df: DataFrame, label: Column, name: str = "cause", roles: Roles = FLIGHT_ROLES, default: float = 0.0
) -> DataFrame:
    """Rows per site and label, with the mean of the site, or a default where the site has none.

    Counts and means come from one aggregate per site and label. Rows without a site are counted with the default.
    """
    totals = shared(
        df.groupBy(F.col(roles.site).alias("origin"), label.alias(name)).agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.sum(roles.measure).alias("dep_sum"),
            F.count(roles.measure).alias("dep_n"),
        )
    )
    counts = totals.select("origin", name, "num_flights")
    joined = counts.join(total_means(totals, only_valid=True), "origin", "left")
    return joined.withColumn("avg_dep_airport", F.coalesce("avg_dep_airport", F.lit(default)))


def with_difference(df: DataFrame) -> DataFrame:
    """Difference of two averages that are already rounded, rounded again."""
    return df.withColumn("dep_diff", F.round(F.col("avg_dep_delay") - F.col("avg_dep_airport"), 4))


def with_rank(df: DataFrame, ties: str = "rank") -> DataFrame:
    """Rank by average, smallest first, NULL before all values.

    ``ties='rank'``: equal averages share a rank and leave a gap. ``'sequential'``:
    1..k without ties, equal averages by name.
    """
    site = Window.partitionBy("origin")
    if ties == "sequential":
        place = F.row_number().over(site.orderBy(F.asc_nulls_first("avg_dep_delay"), "carrier"))
    elif ties == "rank":
        place = F.rank().over(site.orderBy(F.asc_nulls_first("avg_dep_delay")))
    else:
        raise ValueError(f"unknown tie rule: {ties}")
    return df.withColumn("rank", place)


def with_rank_split(df: DataFrame) -> DataFrame:
    """``with_rank`` for groups too large for one task.

    Members with the same average, or with none, share a rank, so ranks are found for the distinct averages of a group,
    with the number of members of each. Spark samples these and cuts them into ranges that hold about equally many, so
    the parts are even however the averages lie; each is walked by itself and the members of the parts of the group
    before it are added. The ranges are written to the shared folder, since the cuts must stay where they are. Offsets
    have one row for each part and group that meet.
    """
    values = df.groupBy("origin", "avg_dep_delay").agg(F.count(F.lit(1)).alias("members"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = values.repartitionByRange(parts, "origin", F.asc_nulls_first("avg_dep_delay"))
    ranged = stored(cut.withColumn("part", F.spark_partition_id()), "rank-ranges")
    lower = Window.partitionBy("origin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("origin", "part")
        .agg(F.sum("members").alias("n"))
        .select("origin", "part", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("offset"))
    )
    order = F.asc_nulls_first("avg_dep_delay")
    before = Window.partitionBy("origin", "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("members").over(before), F.lit(0))
    ranks = (
        ranged.withColumn("inside", inside)
        .join(offsets, ["origin", "part"])
        .select(
            F.col("origin").alias("r_origin"),
            F.col("avg_dep_delay").alias("r_avg"),
            (F.col("offset") + F.col("inside") + 1).cast("int").alias("rank"),
        )
    )
    same = (F.col("origin") == F.col("r_origin")) & F.col("avg_dep_delay").eqNullSafe(F.col("r_avg"))
    return df.join(ranks, same).select(*df.columns, "rank")
