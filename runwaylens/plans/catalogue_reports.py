"""Queries for the three reports and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from runwaylens.functions import delay_band, lookup
from runwaylens.operators import grouping, ranking
from runwaylens.plans import reports
from runwaylens.plans.oracle import over, rounded
from runwaylens.plans.registry import query
from runwaylens.sources.testviews import flights

MONTHLY = f"""
  SELECT op_unique_carrier AS carrier, origin, month, count(*) AS num_flights,
    {rounded("min(arr_delay)", 2)} AS min_arr_delay, {rounded("max(arr_delay)", 2)} AS max_arr_delay,
    {rounded("avg(arr_delay)", 2)} AS avg_arr_delay, {rounded("sum(cancelled) / count(*)", 4)} AS cancel_rate
  FROM flights WHERE op_unique_carrier IS NOT NULL AND origin IS NOT NULL AND month IS NOT NULL
  GROUP BY ALL
"""
ACTIVE_LIST = "SELECT carrier, origin, list_sort(list(DISTINCT month)) AS months_active FROM monthly GROUP BY ALL"
ACTIVE = f"SELECT carrier, origin, array_to_string(months_active, ',') AS months_active FROM ({ACTIVE_LIST})"
AIRLINE = "SELECT m.*, a.months_active FROM monthly m JOIN active a ON m.carrier = a.carrier AND m.origin = a.origin"


@query("airline_stats", over("flights", AIRLINE, monthly=MONTHLY, active=ACTIVE))
def _(spark, sf):
    return reports.airline_stats(flights(spark, sf))


@query("airline_stats_array_months", over("flights", AIRLINE, monthly=MONTHLY, active=ACTIVE_LIST))
def _(spark, sf):
    return reports.airline_stats(flights(spark, sf), months_as_text=False)


@query("airline_stats_joined", over("flights", AIRLINE, monthly=MONTHLY, active=ACTIVE))
def _(spark, sf):
    return reports.airline_stats_joined(flights(spark, sf))


@query("period_stats", over("flights", "SELECT * FROM monthly", monthly=MONTHLY))
def _(spark, sf):
    return grouping.period_stats(flights(spark, sf))


@query("active_months", over("flights", "SELECT * FROM active", monthly=MONTHLY, active=ACTIVE))
def _(spark, sf):
    return grouping.active_periods(grouping.period_stats(flights(spark, sf)))


BAND = "CASE WHEN dep_delay < 15 THEN 'low' WHEN dep_delay <= 60 THEN 'medium' WHEN dep_delay > 60 THEN 'high' END"
BANDS = f"""
  SELECT origin, month, {BAND} AS delay_band, count(*) AS num_flights,
    {rounded("avg(dep_delay)", 2)} AS avg_dep, {rounded("avg(arr_delay)", 2)} AS avg_arr
  FROM flights WHERE origin IS NOT NULL AND month IS NOT NULL AND dep_delay IS NOT NULL GROUP BY ALL
"""
CAUSES = " UNION ALL ".join(
    f"SELECT origin, month, '{c}' AS cause, avg({c}_delay) AS avg_minutes FROM flights WHERE {c}_delay > 0 "
    "GROUP BY origin, month"
    for c in ["carrier", "weather", "nas", "security", "late_aircraft"]
)
RANKED = """
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY origin, month ORDER BY avg_minutes DESC, cause) AS INT) AS rnk
    FROM causes
  ) WHERE rnk <= 3
"""
PIVOTED = "SELECT origin, month, " + ", ".join(
    f"max(CASE WHEN rnk = {k} THEN cause END) AS top_cause_{k}" for k in (1, 2, 3)
) + " FROM ranked GROUP BY origin, month"
PADDED = ", ".join(f"coalesce(p.top_cause_{k}, 'none') AS top_cause_{k}" for k in (1, 2, 3))
DELAY = f"""
  SELECT b.*, {PADDED} FROM bands b LEFT JOIN pivoted p ON b.origin = p.origin AND b.month = p.month
"""
CAUSE_STEPS = {"causes": CAUSES, "ranked": RANKED, "pivoted": PIVOTED}


@query("delay_report", over("flights", DELAY, bands=BANDS, **CAUSE_STEPS))
def _(spark, sf):
    return reports.delay_report(flights(spark, sf))


@query("delay_report_joined", over("flights", DELAY, bands=BANDS, **CAUSE_STEPS))
def _(spark, sf):
    return reports.delay_report_joined(flights(spark, sf))


@query("band_stats", over("flights", "SELECT * FROM bands", bands=BANDS))
def _(spark, sf):
    return grouping.band_stats(flights(spark, sf))


@query(
    "band_counts",
    over("flights", f"SELECT {BAND} AS delay_band, count(*) AS num_flights FROM flights GROUP BY ALL"),
)
def _(spark, sf):
    return flights(spark, sf).groupBy(delay_band("dep_delay").alias("delay_band")).agg(
        F.count(F.lit(1)).alias("num_flights")
    )


CAUSE_ROWS = " UNION ALL ".join(
    f"SELECT origin, month, '{c}' AS cause, {c}_delay AS minutes FROM flights WHERE {c}_delay > 0"
    for c in ["carrier", "weather", "nas", "security", "late_aircraft"]
)


@query("delay_causes_unpivot", over("flights", CAUSE_ROWS))
def _(spark, sf):
    return grouping.cause_rows(flights(spark, sf))


CAUSES_WIDE = "SELECT origin, month, " + ", ".join(
    f"avg(CASE WHEN {c}_delay > 0 THEN {c}_delay END) AS {c}"
    for c in ["carrier", "weather", "nas", "security", "late_aircraft"]
) + " FROM flights GROUP BY ALL"


@query("cause_means_wide", over("flights", CAUSES_WIDE))
def _(spark, sf):
    return grouping.cause_means_wide(flights(spark, sf))


@query("cause_means", over("flights", CAUSES))
def _(spark, sf):
    return grouping.cause_means(flights(spark, sf))


@query("union_all_causes", over("flights", CAUSES))
def _(spark, sf):
    return grouping.cause_means_union(flights(spark, sf))


@query("causes_ranked", over("flights", "SELECT * FROM ranked", causes=CAUSES, ranked=RANKED))
def _(spark, sf):
    return grouping.rank_causes(grouping.cause_means(flights(spark, sf)))


@query("conditional_pivot", over("flights", "SELECT * FROM pivoted", **CAUSE_STEPS))
def _(spark, sf):
    return grouping.pivot_causes(grouping.rank_causes(grouping.cause_means(flights(spark, sf))))


@query(
    "top_causes_padded",
    over(
        "flights",
        f"SELECT w.origin, w.month, {PADDED} FROM places w LEFT JOIN pivoted p "
        "ON w.origin IS NOT DISTINCT FROM p.origin AND w.month IS NOT DISTINCT FROM p.month",
        places="SELECT DISTINCT origin, month FROM flights",
        **CAUSE_STEPS,
    ),
)
def _(spark, sf):
    wide = grouping.cause_means_wide(flights(spark, sf))
    causes = [c for c in wide.columns if c not in ("origin", "month")]
    return wide.select("origin", "month", *grouping.top_cause_columns({c: F.col(c) for c in causes}))


NULL_SAFE_BANDS = f"""
  SELECT origin, month, {BAND} AS delay_band, count(*) AS num_flights
  FROM flights WHERE dep_delay IS NOT NULL GROUP BY ALL
"""


@query(
    "null_safe_report_join",
    over(
        "flights",
        f"SELECT b.*, {PADDED} FROM bands b LEFT JOIN pivoted p "
        "ON b.origin IS NOT DISTINCT FROM p.origin AND b.month IS NOT DISTINCT FROM p.month",
        bands=NULL_SAFE_BANDS,
        **CAUSE_STEPS,
    ),
)
def _(spark, sf):
    return reports.delay_report_null_safe(flights(spark, sf))


MEMBERS = f"""
  SELECT origin, op_unique_carrier AS carrier, count(*) AS num_flights,
    {rounded("avg(dep_delay)", 4)} AS avg_dep_delay, {rounded("avg(arr_delay)", 4)} AS avg_arr_delay,
    {rounded("sum(cancelled) / count(*)", 4)} AS cancel_rate
  FROM flights WHERE origin IS NOT NULL AND op_unique_carrier IS NOT NULL GROUP BY ALL
"""
MEANS = f"""
  SELECT origin, {rounded("avg(dep_delay)", 4)} AS avg_dep_airport
  FROM flights WHERE origin IS NOT NULL GROUP BY origin
"""
VALID_MEANS = f"""
  SELECT origin, {rounded("avg(dep_delay)", 4)} AS avg_dep_airport
  FROM flights WHERE origin IS NOT NULL AND dep_delay IS NOT NULL GROUP BY origin
"""
PLACED = f"""
  SELECT m.*, a.avg_dep_airport, {rounded("m.avg_dep_delay - a.avg_dep_airport", 4)} AS dep_diff
  FROM members m JOIN means a ON m.origin = a.origin
"""
BY_RANK = """
  SELECT *, CAST(rank() OVER (PARTITION BY origin ORDER BY avg_dep_delay ASC NULLS FIRST) AS INT) AS rank FROM placed
"""
BY_ROW = """
  SELECT *, CAST(row_number() OVER (PARTITION BY origin ORDER BY avg_dep_delay ASC NULLS FIRST, carrier) AS INT) AS rank
  FROM placed
"""
RANKING_STEPS = {"members": MEMBERS, "means": MEANS, "placed": PLACED}


@query("carrier_ranking", over("flights", BY_RANK, **RANKING_STEPS))
def _(spark, sf):
    return reports.carrier_ranking(flights(spark, sf))


@query("carrier_ranking_wide_groups", over("flights", BY_RANK, **RANKING_STEPS))
def _(spark, sf):
    return reports.carrier_ranking(flights(spark, sf), wide_groups=True)


@query("carrier_ranking_joined", over("flights", BY_RANK, **RANKING_STEPS))
def _(spark, sf):
    return reports.carrier_ranking_joined(flights(spark, sf))


@query("carrier_ranking_sequential", over("flights", BY_ROW, **RANKING_STEPS))
def _(spark, sf):
    return reports.carrier_ranking(flights(spark, sf), ties="sequential")


@query(
    "carrier_ranking_valid_airports",
    over("flights", BY_ROW, members=MEMBERS, means=VALID_MEANS, placed=PLACED),
)
def _(spark, sf):
    return reports.carrier_ranking_joined(flights(spark, sf), only_valid=True)


@query("delta_to_airport_mean", over("flights", "SELECT origin, carrier, dep_diff FROM placed", **RANKING_STEPS))
def _(spark, sf):
    joined = ranking.members_with_site_mean(flights(spark, sf))
    return ranking.with_difference(joined).select("origin", "carrier", "dep_diff")


@query(
    "carrier_airport_grouping_sets",
    over(
        "flights",
        f"""
        SELECT origin, CASE WHEN grouping(op_unique_carrier) = 0 THEN 'carrier' ELSE 'airport' END AS grain,
          op_unique_carrier AS carrier, count(*) AS num_flights, {rounded("avg(dep_delay)", 4)} AS avg_dep_delay
        FROM flights WHERE origin IS NOT NULL AND op_unique_carrier IS NOT NULL
        GROUP BY GROUPING SETS ((origin, op_unique_carrier), (origin))
        """,
    ),
)
def _(spark, sf):
    return grouping.two_grain_stats(flights(spark, sf))


LABELS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}


@query(
    "map_lookup_default",
    over(
        "flights",
        f"""
        SELECT f.origin, coalesce(CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
            WHEN 'C' THEN 'NAS' WHEN 'D' THEN 'Security' END, 'none') AS cause,
          coalesce(m.avg_dep_airport, 0.0) AS avg_dep_airport, count(*) AS num_flights
        FROM flights f LEFT JOIN means m ON f.origin = m.origin GROUP BY ALL
        """,
        means=VALID_MEANS,
    ),
)
def _(spark, sf):
    cause = lookup("cancellation_code", LABELS, F.lit("none"))
    return ranking.labelled_counts_with_site_mean(flights(spark, sf), cause)
