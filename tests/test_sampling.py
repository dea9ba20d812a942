import pytest
from pyspark.sql import functions as F

from runwaylens.operators import sampling
from runwaylens.sources.readers import read_facts
from runwaylens.sources.scratch import new_folder, shared_root, stored


@pytest.fixture(scope="module")
def table(spark):
    """20,011 rows in many files, two thirds of them equal."""
    path = new_folder(spark, "sample-source")
    df = spark.range(20011).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("v"))
    df.repartition(7).write.parquet(path)
    return read_facts(spark, path)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.25, 0.37, 0.5, 1.0])
def test_exact_size(table, fraction):
    assert sampling.sample_exact(table, fraction, fixed_order=True).count() == round(fraction * 20011)


def test_half_rows_round_to_even(spark):
    df = spark.range(10)
    assert sampling.sample_exact(df, 0.25, key=["id"]).count() == 2
    assert sampling.sample_exact(df, 0.35, key=["id"]).count() == 4


def test_without_replacement(spark):
    df = spark.range(5000)
    picked = sampling.sample_exact(df, 0.4, key=["id"])
    assert picked.distinct().count() == picked.count() == 2000


def test_same_seed_same_rows(table):
    one = sampling.sample_exact(table, 0.3, seed=7, fixed_order=True).agg(F.sum("v")).first()
    two = sampling.sample_exact(table, 0.3, seed=7, fixed_order=True).agg(F.sum("v")).first()
    other = sampling.sample_exact(table, 0.3, seed=8, fixed_order=True).agg(F.sum("v")).first()
    assert one == two != other


def test_key_choice_does_not_depend_on_layout(spark):
    df = spark.range(3000)
    one = sampling.sample_exact(df.repartition(3), 0.2, key=["id"])
    two = sampling.sample_exact(df.repartition(11), 0.2, key=["id"])
    assert one.exceptAll(two).count() == 0


def test_sample_is_even(spark):
    df = spark.range(20000)
    halves = sampling.sample_exact(df, 0.5, key=["id"]).groupBy(F.col("id") < 10000).count().collect()
    assert all(abs(r["count"] - 5000) < 300 for r in halves)


def test_shuffled_input_is_stored_first(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert sampling.sample_exact(df, 0.5).count() == 5
    assert sampling.oversample_exact(df, 1.5).count() == 15


def test_row_index_is_dense(table):
    r = sampling.with_row_index(table).agg(
        F.min("row_index"), F.max("row_index"), F.count_distinct("row_index"), F.max("row_total")
    )
    assert tuple(r.first()) == (0, 20010, 20011, 20011)


@pytest.mark.parametrize("fraction,extra", [(1.25, 5002), (1.5, 10005), (2.0, 20011), (3.7, 54029)])
def test_oversample_size(table, fraction, extra):
    assert sampling.oversample_exact(table, fraction, fixed_order=True).count() == 20011 + extra


def test_oversample_of_ten(spark):
    path = new_folder(spark, "ten")
    spark.range(10).write.parquet(path)
    assert sampling.oversample_exact(read_facts(spark, path), 1.25, fixed_order=True).count() == 12


def test_oversample_keeps_every_row_and_repeats_some(spark):
    path = new_folder(spark, "repeat")
    spark.range(4000).repartition(5).write.parquet(path)
    hits = sampling.oversample_exact(read_facts(spark, path), 1.5, fixed_order=True).groupBy("id").count()
    r = hits.agg(F.count(F.lit(1)).alias("keys"), F.min("count").alias("low"), F.max("count").alias("high")).first()
    assert r.keys == 4000 and r.low == 1 and r.high >= 3


def test_fraction_is_checked(spark):
    with pytest.raises(ValueError):
        sampling.sample_exact(spark.range(3), 1.2)
    with pytest.raises(ValueError):
        sampling.oversample_exact(spark.range(3), 0.5)


def test_fast_sample_is_near(spark):
    df = spark.range(20000)
    assert abs(sampling.sample_fraction(df, 0.25).count() - 5000) < 400
    assert abs(sampling.sample_fraction(df, 1.5).count() - 30000) < 600


def test_suite(spark, table):
    source, out = new_folder(spark, "suite-in"), new_folder(spark, "suite-out")
    table.write.parquet(source)
    got = {r.name: r.rows for r in sampling.write_sample_suite(spark, source, out).collect()}
    assert got == {
        "sample_010pct": 2001,
        "sample_025pct": 5003,
        "sample_050pct": 10006,
        "sample_125pct": 25013,
        "sample_150pct": 30016,
    }
    assert read_facts(spark, f"{out}/sample_010pct").count() == 2001


def test_stored_goes_to_the_shared_folder(spark):
    df = stored(spark.range(5), "kept")
    assert df.inputFiles() and all(shared_root(spark) in f for f in df.inputFiles())
    assert df.count() == 5


def scans_of(spark, path, run):
    """How many scans of a folder the jobs of ``run`` make."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = store.executionsList().drop(int(before)).iterator()
    texts = []
    while found.hasNext():
        texts.append(found.next().physicalPlanDescription())
    return sum(1 for t in texts for part in t.split("\n\n") if "Scan parquet" in part and path in part)


@pytest.mark.parametrize("fractions", [[0.2], [0.01, 0.1, 0.25, 0.5, 1.0, 1.25, 1.5, 3.5]])
def test_three_scans_for_any_number_of_samples(spark, table, fractions):
    source, out = table.inputFiles()[0].rpartition("/")[0], new_folder(spark, "suite")
    folder = source.rpartition("/")[2]
    assert scans_of(spark, folder, lambda: sampling.write_samples(table, out, fractions, fixed_order=True)) == 3
    n = table.count()
    for f in fractions:
        want = round(n * f) if f <= 1 else n + int(n * (f - 1))
        assert spark.read.parquet(f"{out}/{sampling.sample_name(f)}").count() == want


def test_suite_samples_equal_single_ones(spark, table):
    out = new_folder(spark, "suite")
    sampling.write_samples(table, out, [0.3, 0.1, 1.4], fixed_order=True)
    for f in (0.1, 0.3, 1.4):
        alone = sampling.scaled_sample(table, f, fixed_order=True)
        written = spark.read.parquet(f"{out}/{sampling.sample_name(f)}")
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, alone.collect()))
    small, large = (spark.read.parquet(f"{out}/sample_{x}pct") for x in ("010", "030"))
    assert small.exceptAll(large).count() == 0


def test_samples_of_small_and_empty_tables(spark):
    for n in (0, 1, 2, 7):
        path, out = new_folder(spark, "small"), new_folder(spark, "suite")
        spark.range(n).withColumn("sample", F.lit("x")).write.parquet(path)
        sampling.write_samples(read_facts(spark, path), out, [0.1, 0.5, 1.0, 1.5, 9.0], fixed_order=True)
        got = [spark.read.parquet(f"{out}/{sampling.sample_name(f)}") for f in (0.1, 0.5, 1.0, 1.5, 9.0)]
        assert [df.count() for df in got] == [round(n * 0.1), round(n * 0.5), n, n + int(n * 0.5), 9 * n]
        assert all(df.columns == ["id", "sample"] for df in got)


def test_names_must_differ(spark, table):
    with pytest.raises(ValueError):
        sampling.write_samples(table, "unused", [0.1, 0.101], fixed_order=True)


def test_larger_samples_never_shuffle_whole_rows_and_are_even(spark):
    """Copies of a row are spread as independent draws are: chi-square over rows, and over copies of copies."""
    path = new_folder(spark, "even")
    spark.range(6000).select("id", F.lit("same wide row").alias("v")).repartition(5).write.parquet(path)
    picked = sampling.oversample_exact(read_facts(spark, path), 4.0, fixed_order=True)
    assert "Exchange" not in picked._jdf.queryExecution().executedPlan().toString()
    hits = {r.id: r["count"] - 1 for r in picked.groupBy("id").count().collect()}
    assert sum(hits.values()) == 18000 and len(hits) == 6000
    spread = sum((h - 3.0) ** 2 for h in hits.values()) / 3.0
    assert abs(spread - 6000) < 6 * (2 * 6000) ** 0.5
    shares = [sum(1 for h in hits.values() if h == k) / 6000 for k in range(3)]
    assert all(abs(got - want) < 0.03 for got, want in zip(shares, [0.0498, 0.1494, 0.2240], strict=True))
    parts = [sum(h for i, h in hits.items() if i % 6 == k) for k in range(6)]
    assert all(abs(p - 3000) < 300 for p in parts)


def test_poisson_steps_are_sums_of_probabilities():
    steps = sampling.poisson_steps(0.3125)
    assert abs(steps[0] - 0.7316156289466418) < 1e-15 and abs(steps[1] - steps[0] * 1.3125) < 1e-15
    assert steps == sorted(steps) and 1 - steps[-1] < 1e-12
