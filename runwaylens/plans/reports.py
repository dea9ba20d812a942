"""The three reports. Each reads the fact table once and shuffles only aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runwaylens.functions import mean_from, present
from runwaylens.operators.grouping import (
    active_periods,
    band_cells,
    cell_cause_means,
    pad_causes,
    period_stats,
    pivot_causes,
    rank_causes,
    top_cause_columns,
    with_active_periods,
)
from runwaylens.operators.joins import same_keys, shared
from runwaylens.operators.ranking import (
    member_totals,
    members_with_site_mean,
    with_difference,
    with_rank,
    with_rank_split,
    with_site_mean,
    with_site_mean_joined,
)
from runwaylens.schema import FLIGHT_ROLES, Roles
from runwaylens.sources.scratch import stored

RANKING_COLUMNS = [
    "origin",
    "carrier",
    "num_flights",
    "avg_dep_delay",
    "avg_arr_delay",
    "cancel_rate",
    "avg_dep_airport",
    "dep_diff",
    "rank",
]


def airline_stats(df: DataFrame, roles: Roles = FLIGHT_ROLES, months_as_text: bool = True) -> DataFrame:
    """Statistics per carrier, airport and month, with the months in which the pair is active."""
    return with_active_periods(period_stats(df, roles), months_as_text).orderBy("carrier", "origin", "month")


def airline_stats_joined(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Same result with the active months joined back to the monthly rows; both sides share one aggregate."""
    stats = shared(period_stats(df, roles))
    return stats.join(active_periods(stats), ["carrier", "origin"]).orderBy("carrier", "origin", "month")


def delay_report(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Delay bands per airport and month, with the three causes of the highest average delay.

    Bands and causes come from one aggregate: its rows per (airport, month, band) also carry
    the sums of the causes, and rows without a band are kept until the causes are summed over
    the bands. The window then sees at most four rows per airport and month.
    """
    cells = band_cells(df.where(present(roles.site, roles.period)), roles)
    place = Window.partitionBy("origin", "month")
    figures = ["origin", "month", "delay_band", "num_flights", "avg_dep", "avg_arr"]
    means = [
        mean_from(F.sum(f"sum_{label}").over(place), F.sum(f"n_{label}").over(place)).alias(f"mean_{label}")
        for label in roles.causes
    ]
    top = top_cause_columns({label: F.col(f"mean_{label}") for label in roles.causes})
    return (
        cells.select(*figures, *means)
        .where("delay_band IS NOT NULL")
        .select(*figures, *top)
        .orderBy("origin", "month", "delay_band")
    )


def delay_report_joined(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Same result by a left join of ranked and pivoted causes to the bands; both come from the same cells."""
    cells = shared(band_cells(df.where(present(roles.site, roles.period)), roles))
    bands = cells.where(present("delay_band")).select("origin", "month", "delay_band", "num_flights", "avg_dep", "avg_arr")
    causes = pivot_causes(rank_causes(cell_cause_means(cells, roles)))
    return pad_causes(bands.join(causes, ["origin", "month"], "left")).orderBy("origin", "month", "delay_band")


def delay_report_null_safe(df: DataFrame, roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Variant that keeps rows without airport or month, whose NULL keys match each other."""
    cells = shared(band_cells(df, roles))
    bands = cells.where(present("delay_band")).select("origin", "month", "delay_band", "num_flights")
    causes = pivot_causes(rank_causes(cell_cause_means(cells, roles))).withColumnsRenamed(
        {"origin": "cause_origin", "month": "cause_month"}
    )
    same = same_keys(["origin", "month"], ["cause_origin", "cause_month"])
    return pad_causes(bands.join(causes, same, "left").drop("cause_origin", "cause_month"))


def carrier_ranking(
    df: DataFrame, roles: Roles = FLIGHT_ROLES, ties: str = "rank", wide_groups: bool = False
) -> DataFrame:
    """Carriers of each airport by average departure delay, against the airport's own average.

    One aggregate per (airport, carrier); the airport mean and the rank share one shuffle of
    its rows. Set ``wide_groups`` where a single airport has so many members that its
    aggregated rows should be spread over several tasks; the totals are then written to the
    shared folder first, so that means, offsets and ranks do not read the facts again.
    """
    if wide_groups and ties != "rank":
        raise ValueError("wide_groups supports ties='rank' only")
    totals = member_totals(df, roles)
    totals = stored(totals, "member-totals") if wide_groups else totals
    placed = with_site_mean_joined(totals) if wide_groups else with_site_mean(totals)
    figures = with_difference(
        placed.where("carrier IS NOT NULL").withColumn(
            "avg_dep_delay", F.round(mean_from("dep_sum", "dep_n"), 4)
        )
    )
    ranked = with_rank_split(figures) if wide_groups else with_rank(figures, ties)
    return ranked.select(*RANKING_COLUMNS).orderBy("origin", "rank", "carrier")


def carrier_ranking_joined(df: DataFrame, roles: Roles = FLIGHT_ROLES, only_valid: bool = False) -> DataFrame:
    """Same result by a join of members and site means, which share one aggregate.

    With ``only_valid`` airports without any departure delay are left out, and ties are
    broken, as when the means are filtered before an inner join.
    """
    stats = members_with_site_mean(df, roles, only_valid)
    ranked = with_rank(with_difference(stats), "sequential" if only_valid else "rank")
    return ranked.select(*RANKING_COLUMNS).orderBy("origin", "rank", "carrier")
