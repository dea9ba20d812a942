import pytest
from helpers import facts, flight, raw, rows
from pyspark.sql import functions as F

from runwaylens.operators import grouping, profile
from runwaylens.sources.scratch import Workspace


@pytest.fixture
def delays(spark):
    return facts(
        spark,
        *[flight(dep=d, arr=a, cancelled=c) for d, a, c in [(1, 2, 0.0), (2, 4, 0.0), (3, None, 0.0), (10, 8, 1.0)]],
        flight("BB", "LAX", 2, None, None, cancelled=1.0, cancellation_code="B"),
    )


def test_null_profile_order_and_share(delays):
    got = rows(profile.null_profile(delays.select("dep_delay", "arr_delay", "origin")))
    assert got == [("arr_delay", 2, 40.0), ("dep_delay", 1, 20.0), ("origin", 0, 0.0)]


def test_profiles_of_an_empty_table(delays):
    none = delays.limit(0)
    assert rows(profile.null_profile(none.select("origin"))) == [("origin", 0, None)]
    assert rows(profile.duplicate_profile(none)) == [(0, 0, None)]
    assert rows(profile.row_count(none)) == [(0,)]


def test_duplicates_count_rows_after_the_first(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(profile.duplicate_profile(df)) == [(4, 2, 50.0)]


def test_describe_interpolates(delays):
    got = {r.column: tuple(r)[1:] for r in profile.describe(delays, ["dep_delay", "arr_delay"]).collect()}
    assert got["dep_delay"] == (4, 4.0, 4.08, 1.0, 1.75, 2.5, 4.75, 10.0)
    assert got["arr_delay"] == (3, 4.67, 3.06, 2.0, 3.0, 4.0, 6.0, 8.0)


def test_describe_of_one_value_has_no_deviation(spark):
    got = profile.describe(facts(spark, flight(dep=5)), ["dep_delay"]).first()
    assert (got["count"], got["std"], got["p50"]) == (1, None, 5.0)


def test_describe_sketch_agrees_on_moments(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("dep_delay"))
    exact = profile.describe(df, ["dep_delay"]).first()
    sketch = profile.describe(df, ["dep_delay"], exact=False).first()
    assert [exact[c] for c in ("count", "mean", "std", "min", "max")] == [
        sketch[c] for c in ("count", "mean", "std", "min", "max")
    ]
    assert abs(exact.p50 - sketch.p50) <= 1


def test_scalar_stats(delays):
    assert rows(profile.scalar_stats(delays, ["dep_delay"])) == [("dep_delay", 1.0, 10.0, 4.0, 4.1)]


def test_value_counts(delays):
    assert rows(profile.value_counts(delays, "origin")) == [("JFK", 4), ("LAX", 1)]
    assert rows(profile.value_counts(delays, "month", by_value=True)) == [(1, 4), (2, 1)]
    assert rows(profile.cancellation_causes(delays)) == [("Weather", 1)]


def test_flags(delays):
    assert rows(profile.flag_share(delays)) == [(2, 40.0, 3)]
    assert rows(profile.flag_rate_by(delays, "op_unique_carrier")) == [("BB", 100.0), ("AA", 25.0)]


def test_means(delays):
    assert rows(profile.means_by_entity(delays)) == [("AA", 4.0, 4.67), ("BB", None, None)]
    assert [r.month_label for r in profile.means_by_month(delays).collect()] == ["Gen", "Feb"]


def test_top_counts_values_not_rows(delays):
    assert rows(profile.top_by_mean(delays, min_count=4)) == [("JFK", 4.0, 4)]
    assert rows(profile.top_by_mean(delays, min_count=5)) == []
    assert rows(profile.top_by_count(delays, n=1)) == [("JFK", 4)]


def test_histogram_clips_and_closes_the_last_bin(spark):
    df = facts(spark, *[flight(dep=d, arr=1) for d in (-500, -60, 0, 299, 300, 9999)], flight())
    got = [r for r in profile.histogram(df, bins=4).orderBy("column", "bin").collect()]
    dep = [(r.bin, r.bin_start, r["count"]) for r in got if r.column == "dep_delay"]
    assert dep == [(0, -60.0, 3), (1, 30.0, 0), (2, 120.0, 0), (3, 210.0, 3)]
    arr = [(r.bin, r.bin_start, r["count"]) for r in got if r.column == "arr_delay"]
    assert arr == [(0, 0.5, 0), (1, 0.75, 0), (2, 1.0, 6), (3, 1.25, 0)]


def test_before_after(spark):
    before = raw(spark, {"origin": "A", "cancelled": "1"}, {"origin": "A", "cancelled": "1"}, {"dep_delay": "3"})
    got = {r.metric: (r.raw, r.cleaned) for r in profile.before_after(before, before.distinct()).collect()}
    assert got == {
        "rows": (3.0, 2.0),
        "columns": (15.0, 15.0),
        "duplicates": (1.0, 0.0),
        "missing_dep_delay": (2.0, 1.0),
        "total_cancelled": (2.0, 1.0),
    }


def test_two_grains(spark):
    df = facts(spark, flight("AA", dep=1), flight("BB", dep=4), flight("BB", dep=None))
    got = {(r.grain, r.carrier): (r.num_flights, r.avg_dep_delay) for r in grouping.two_grain_stats(df).collect()}
    assert got == {("carrier", "AA"): (1, 1.0), ("carrier", "BB"): (2, 4.0), ("airport", None): (3, 2.5)}


@pytest.mark.parametrize(
    "value",
    ["1700000000 + id * 5", "id / 40000000.0", "IF(id % 3 = 0, 7.0, id)", "IF(id % 2 = 0, -id, id * 1000000)"],
    ids=["epoch seconds", "share near zero", "one hot value", "two scales"],
)
def test_quartiles_of_awkward_columns(spark, value):
    df = spark.range(20_000).selectExpr(f"CAST({value} AS DOUBLE) AS v").repartition(4)
    got = profile.describe(df, ["v"]).first()
    want = df.agg(F.percentile("v", [0.25, 0.5, 0.75])).first()[0]
    assert [got.p25, got.p50, got.p75] == pytest.approx([round(w, 2) for w in want], abs=0.011)


@pytest.mark.parametrize(
    "value",
    ["1700000000 + id * 5", "id / 40000000.0", "IF(id = 7, 1e300, 1700000000 + id * 1e-4)", "IF(id % 2 = 0, -id, id * 1000000)"],
    ids=["epoch seconds", "share near zero", "cluster and one far outlier", "two scales"],
)
def test_ranges_follow_the_values(spark, value):
    """Even parts, whatever the values; quartiles over many parts equal those of one."""
    df = spark.range(40_000).selectExpr(f"CAST({value} AS DOUBLE) AS v", "CAST(id % 3 AS DOUBLE) AS w", "-id AS x").repartition(4)
    with Workspace(spark, "ranges") as work:
        freq = work.save(profile.value_frequencies(df, ["v", "w", "x"]), "frequencies")
        ranged = profile.in_ranges(freq, work, part_values=2_000)
        sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
        assert len(sizes) > 30 and max(sizes) <= 3 * 2_000
        many = {r.at: r for r in profile.frequency_stats(ranged).collect()}
        one = {r.at: r for r in profile.frequency_stats(profile.in_ranges(freq, work)).collect()}
    want = df.agg(*[F.percentile(c, [0.25, 0.5, 0.75]) for c in ("v", "w", "x")]).first()
    for i in range(3):
        assert many[i].q == pytest.approx(want[i]) and many[i].q == one[i].q
        assert (many[i]["count"], many[i].min, many[i].max) == (one[i]["count"], one[i].min, one[i].max)
        assert many[i].std == pytest.approx(one[i].std)


def test_duplicates_by_digest_equal_whole_rows(spark):
    """NULL and empty, shifted cells, zeros of both signs and NaN are told apart, or not, as whole rows are."""
    cells = [None, "", "a", "ab", "b"]
    table = [(x, y, z) for x in cells for y in cells for z in (None, 0.0, -0.0, float("nan"), 1.5)]
    df = spark.createDataFrame(table + table[::3], "a string, b string, c double").withColumn("d", F.array("a", "b"))
    whole = profile.copies(df).agg(F.sum("copies"), F.sum("copies") - F.count(F.lit(1))).first()
    got = profile.duplicate_profile(df).first()
    assert (got.rows, got.duplicates) == tuple(whole)
    plan = profile.digest_copies(df)._jdf.queryExecution().executedPlan().toString()
    shuffled = plan.split("Exchange")[1].split("\n")[0]
    assert "digest_1" in shuffled and "a#" not in shuffled


def test_describe_leaves_nothing_behind(spark, delays):
    import os

    from runwaylens.sources.scratch import shared_root

    before = set(os.listdir(shared_root(spark).removeprefix("file:")))
    assert profile.describe(delays, ["dep_delay"]).count() == 1
    left = set(os.listdir(shared_root(spark).removeprefix("file:"))) - before
    assert all(not os.listdir(f"{shared_root(spark).removeprefix('file:')}/{d}") for d in left)
