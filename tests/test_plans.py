"""The physical plans stay inside the JVM, read each input once and prune what they read."""

import re

import pytest
from pyspark.sql import functions as F

from runwaylens.operators import grouping, ranking
from runwaylens.plans.catalogue import QUERIES
from runwaylens.plans import reports
from runwaylens.sources.readers import read_facts
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.testviews import flights

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan(df).count("FileScan")


@pytest.fixture(scope="module")
def stored_facts(spark):
    path = new_folder(spark, "plan-facts")
    flights(spark, DATA).write.parquet(path)
    return read_facts(spark, path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("report", [reports.airline_stats, reports.delay_report, reports.carrier_ranking])
def test_reports_scan_once_and_join_nothing(stored_facts, report):
    df = report(stored_facts)
    assert scans(df) == 1
    assert "Join" not in plan(df)
    assert "partial_count" in plan(df)


def test_wide_groups_read_the_facts_once(stored_facts):
    facts_path = re.search(r"plan-facts-\w+", plan(stored_facts)).group(0)
    text = plan(reports.carrier_ranking(stored_facts, wide_groups=True))
    assert facts_path not in text and "member-totals" in text


def executed_scans(df):
    """Scans of the plan that has run; a reused shuffle is one scan."""
    df.collect()
    return plan(df).partition("Initial Plan")[0].count("FileScan")


JOINED = {
    "airline_stats": reports.airline_stats_joined,
    "delay_report": reports.delay_report_joined,
    "null_safe": reports.delay_report_null_safe,
    "ranking": reports.carrier_ranking_joined,
    "valid_ranking": lambda df: reports.carrier_ranking_joined(df, only_valid=True),
    "difference": ranking.members_with_site_mean,
    "labelled": lambda df: ranking.labelled_counts_with_site_mean(df, F.col("cancellation_code")),
    "union": grouping.cause_means_union,
}


@pytest.mark.parametrize("name", sorted(JOINED))
def test_both_sides_of_a_join_come_from_one_scan(stored_facts, name):
    df = JOINED[name](stored_facts)
    assert executed_scans(df) == 1
    assert "ReusedExchange" in plan(df) or "ReusedQueryStage" in plan(df)


def read_columns(df):
    return {
        c.split(":")[0] for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)) for c in m.split(",")
    }


def test_only_needed_columns_are_read(stored_facts):
    assert read_columns(reports.airline_stats(stored_facts)) == {
        "month", "op_unique_carrier", "origin", "arr_delay", "cancelled",
    }
    assert "fl_date" not in read_columns(reports.delay_report(stored_facts))


def test_key_filters_reach_the_files(stored_facts):
    text = plan(reports.airline_stats(stored_facts))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert all(f"IsNotNull({c})" in pushed for c in ("op_unique_carrier", "origin", "month"))
