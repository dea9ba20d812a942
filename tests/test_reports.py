import os

import pytest
from helpers import facts, flight, rows
from pyspark.sql import functions as F

from runwaylens.operators import ranking
from runwaylens.plans import reports
from runwaylens.schema import Roles
from runwaylens.sources.scratch import shared_root


def test_months_are_sorted_as_numbers(spark):
    df = facts(spark, *[flight(month=m, arr=1) for m in (10, 9, 1, 9)])
    assert {r.months_active for r in reports.airline_stats(df).collect()} == {"1,9,10"}
    as_list = reports.airline_stats(df, months_as_text=False)
    assert {tuple(r.months_active) for r in as_list.collect()} == {(1, 9, 10)}


def test_group_without_arrivals(spark):
    df = facts(spark, flight(cancelled=1.0), flight(cancelled=1.0))
    r = reports.airline_stats(df).first()
    assert (r.num_flights, r.min_arr_delay, r.max_arr_delay, r.avg_arr_delay, r.cancel_rate) == (2, None, None, None, 1.0)


def test_figures_round_half_up(spark):
    df = facts(spark, *[flight(arr=a) for a in (1, 1, 1, 1, 1, 1, 1, 2)])
    assert reports.airline_stats(df).first().avg_arr_delay == 1.13


def test_rows_without_keys_are_left_out(spark):
    df = facts(spark, flight(arr=1), flight(carrier=None), flight(origin=None), flight(month=None))
    assert [r.num_flights for r in reports.airline_stats(df).collect()] == [1]


def test_band_edges(spark):
    df = facts(spark, *[flight(dep=d, arr=0) for d in (14, 15, 60, 61, None)])
    got = {r.delay_band: (r.num_flights, r.avg_dep) for r in reports.delay_report(df).collect()}
    assert got == {"low": (1, 14.0), "medium": (2, 37.5), "high": (1, 61.0)}


def test_missing_arrivals_do_not_count_in_the_band_average(spark):
    df = facts(spark, flight(dep=20, arr=10), flight(dep=20, arr=None))
    assert reports.delay_report(df).first().avg_arr == 10.0


def test_causes_are_padded_and_zero_is_no_cause(spark):
    df = facts(spark, flight(dep=20, arr=20, carrier_delay=0.0, nas_delay=7.0))
    r = reports.delay_report(df).first()
    assert (r.top_cause_1, r.top_cause_2, r.top_cause_3) == ("nas", "none", "none")


def test_causes_rank_by_average_of_positive_minutes(spark):
    df = facts(
        spark,
        flight(dep=20, arr=20, carrier_delay=10.0, weather_delay=30.0, security_delay=1.0),
        flight(dep=20, arr=20, carrier_delay=10.0, weather_delay=0.0, late_aircraft_delay=20.0),
    )
    r = reports.delay_report(df).first()
    assert (r.top_cause_1, r.top_cause_2, r.top_cause_3) == ("weather", "late_aircraft", "carrier")


def test_causes_of_rows_without_departure_count(spark):
    df = facts(spark, flight(dep=5, arr=5), flight(dep=None, arr=20, weather_delay=9.0))
    got = rows(reports.delay_report(df).select("delay_band", "num_flights", "top_cause_1"))
    assert got == [("low", 1, "weather")]


def test_equal_causes_go_by_name(spark):
    df = facts(spark, flight(dep=20, arr=20, weather_delay=5.0, carrier_delay=5.0, nas_delay=5.0))
    r = reports.delay_report(df).first()
    assert (r.top_cause_1, r.top_cause_2, r.top_cause_3) == ("carrier", "nas", "weather")


@pytest.fixture
def tied(spark):
    return facts(spark, flight("AA", dep=5), flight("BB", dep=5), flight("CC", dep=7))


def test_rank_leaves_gaps(tied):
    assert rows(reports.carrier_ranking(tied).select("carrier", "rank")) == [("AA", 1), ("BB", 1), ("CC", 3)]


def test_sequential_rank_has_no_ties(tied):
    got = reports.carrier_ranking(tied, ties="sequential").select("carrier", "rank")
    assert rows(got) == [("AA", 1), ("BB", 2), ("CC", 3)]


def test_unknown_tie_rule_is_refused(tied):
    with pytest.raises(ValueError):
        reports.carrier_ranking(tied, ties="dense")


def test_missing_average_ranks_first(spark):
    df = facts(spark, flight("AA", dep=None), flight("BB", dep=3))
    for wide in (False, True):
        got = rows(reports.carrier_ranking(df, wide_groups=wide).select("carrier", "avg_dep_delay", "dep_diff", "rank"))
        assert got == [("AA", None, None, 1), ("BB", 3.0, 0.0, 2)]


def test_rows_without_carrier_count_in_the_airport_mean_only(spark):
    df = facts(spark, flight("AA", dep=0), flight(None, dep=100))
    for wide in (False, True):
        got = rows(reports.carrier_ranking(df, wide_groups=wide).select("carrier", "avg_dep_airport", "rank"))
        assert got == [("AA", 50.0, 1)]


def test_airports_without_departures_can_be_left_out(spark):
    df = facts(spark, flight("AA", "JFK", dep=None), flight("AA", "LAX", dep=1))
    assert {r.origin for r in reports.carrier_ranking(df).collect()} == {"JFK", "LAX"}
    assert {r.origin for r in reports.carrier_ranking_joined(df, only_valid=True).collect()} == {"LAX"}


def test_difference_uses_rounded_averages(spark):
    df = facts(spark, *[flight("AA", dep=d) for d in (1, 1, 2)], *[flight("BB", dep=d) for d in (2, 2, 3)])
    got = {r.carrier: (r.avg_dep_delay, r.avg_dep_airport, r.dep_diff) for r in reports.carrier_ranking(df).collect()}
    assert got == {"AA": (1.3333, 1.8333, -0.5), "BB": (2.3333, 1.8333, 0.5)}


def test_wide_groups_rank_like_one_window(spark):
    members = spark.range(5000).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("op_unique_carrier"),
        F.lit("HUB").alias("origin"),
        F.lit(1).alias("month"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 997 / 4).cast("double")).alias("dep_delay"),
        F.lit(0.0).alias("arr_delay"),
        F.lit(0.0).alias("cancelled"),
    )
    columns = ["carrier", "rank", "avg_dep_airport"]
    narrow = set(rows(reports.carrier_ranking(members).select(columns)))
    assert narrow == set(rows(reports.carrier_ranking(members, wide_groups=True).select(columns)))


def test_one_pass_reports_equal_the_joined_forms(spark):
    rows_ = [
        flight(c, o, m, d, None if d == 7 else d - 3, carrier_delay=float(d % 4), weather_delay=float(d % 3))
        for c in ("AA", "BB", None)
        for o in ("JFK", "LAX", None)
        for m in (1, 2, 12)
        for d in (-5, 7, 15, 61)
    ]
    df = facts(spark, *rows_)
    for one, two in [
        (reports.airline_stats, reports.airline_stats_joined),
        (reports.delay_report, reports.delay_report_joined),
        (reports.carrier_ranking, reports.carrier_ranking_joined),
    ]:
        assert rows(one(df)) == rows(two(df))


def test_roles_fit_another_table(spark):
    sales = spark.createDataFrame(
        [("shop1", "north", 3, 5.0, 2.0, 0.0, 4.0), ("shop2", "north", 3, 70.0, 4.0, 1.0, None)],
        "shop string, region string, week int, wait double, cost double, refunded double, traffic double",
    )
    roles = Roles("shop", "region", "week", "wait", "cost", "refunded", {"traffic": "traffic"})
    assert rows(reports.carrier_ranking(sales, roles).select("carrier", "rank")) == [("shop1", 1), ("shop2", 2)]
    assert {r.top_cause_1 for r in reports.delay_report(sales, roles).collect()} == {"traffic"}
    assert {r.months_active for r in reports.airline_stats(sales, roles).collect()} == {"3"}


def test_wide_ranks_spread_clustered_averages(spark):
    """Averages that lie close together beside a far one: the ranges hold about equally many of them."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 4 = 0, 'JFK', 'LAX') AS origin", "CAST(id AS STRING) AS carrier",
        "CASE WHEN id = 5 THEN 1e12 WHEN id % 50 = 0 THEN NULL ELSE 100 + (id % 9000) * 1e-6 END AS avg_dep_delay",
    )
    got = ranking.with_rank_split(df).select("carrier", "rank").collect()
    want = ranking.with_rank(df).select("carrier", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    root = shared_root(spark).removeprefix("file:")
    newest = max((d for d in os.listdir(root) if d.startswith("rank-ranges")), key=lambda d: os.path.getmtime(f"{root}/{d}"))
    sizes = [r["count"] for r in spark.read.parquet(f"{root}/{newest}").groupBy("part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 3 * sum(sizes) / len(sizes)
