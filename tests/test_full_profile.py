"""The shared profile gives the tables of the single functions, from three scans."""

import pytest
from helpers import facts, flight

from runwaylens.operators import profile
from runwaylens.operators.full_profile import full_profile
from runwaylens.sources.readers import read_facts
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.testviews import flights
from runwaylens.sources.writers import write_delimited
from test_sampling import scans_of

SINGLE = {
    "nulls": profile.null_profile,
    "duplicates": profile.duplicate_profile,
    "by_month": lambda df: profile.value_counts(df, "month", by_value=True),
    "by_carrier": lambda df: profile.value_counts(df, "op_unique_carrier"),
    "histogram": profile.histogram,
    "cancelled": profile.flag_share,
    "cancel_causes": profile.cancellation_causes,
    "cancel_rate": lambda df: profile.flag_rate_by(df, "op_unique_carrier"),
    "delay_by_carrier": profile.means_by_entity,
    "delay_by_month": profile.means_by_month,
    "top_by_count": profile.top_by_count,
    "top_by_delay": profile.top_by_mean,
    "describe": profile.describe,
}


def table(df, ordered):
    rows = [tuple(pytest.approx(x) if isinstance(x, float) else x for x in r) for r in df.collect()]
    return rows if ordered else sorted(rows, key=repr)


@pytest.fixture(scope="module")
def stored_facts(spark):
    path = new_folder(spark, "profile-facts")
    flights(spark, "/root/testdata/sf0.01").write.parquet(path)
    return path


def test_tables_equal_single_functions(spark, stored_facts):
    df = read_facts(spark, stored_facts)
    parts = full_profile(df)
    assert list(parts) == list(SINGLE)
    for name, single in SINGLE.items():
        want, ordered = single(df), name not in ("histogram", "describe")
        assert parts[name].columns == want.columns, name
        assert [t for _, t in parts[name].dtypes] == [t for _, t in want.dtypes], name
        got = table(parts[name], ordered)
        assert got == [tuple(r) for r in (want.collect() if ordered else sorted(want.collect(), key=lambda r: repr(tuple(r))))], name
        assert got, name


def test_at_most_three_scans(spark, stored_facts):
    def run():
        out = new_folder(spark, "profile-out")
        for name, part in full_profile(read_facts(spark, stored_facts)).items():
            write_delimited(part, f"{out}/{name}")

    assert scans_of(spark, stored_facts.rpartition("/")[2], run) <= 3


def test_empty_and_missing(spark):
    for df in (facts(spark, flight()).limit(0), facts(spark, flight(None, None, None), flight(None, None, None))):
        parts = full_profile(df)
        for name in ("nulls", "duplicates", "cancelled", "by_month", "top_by_delay", "describe"):
            assert sorted(map(tuple, parts[name].collect()), key=repr) == sorted(map(tuple, SINGLE[name](df).collect()), key=repr), name
