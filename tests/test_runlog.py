import datetime as dt

import pytest
from helpers import rows

from runwaylens.functions import lookup, position_in
from runwaylens.operators import runlog
from runwaylens.schema import RUN_LOG_SCHEMA
from runwaylens.sources.readers import read_run_log, with_run_order
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.writers import write_csv


def run(analysis, tech, env, elapsed, notes=None, file="a.parquet", size=1.0, n=1000, day=1):
    return (dt.datetime(2024, 1, day), analysis, tech, env, file, size, n, float(elapsed), 0, notes)


@pytest.fixture
def log(spark):
    return with_run_order(
        spark.createDataFrame(
            [
                run("3.1", "hive", "local", 10),
                run("3.1", "sql", "local", 2),
                run("3.1", "hive", "cluster", 4),
                run("3.1", "sql", "cluster", 8),
                run("3.2", "hive", "local", 6),
                run("3.1", "hive", "local", 9, "sample_010pct", "s.csv", 80.0),
                run("3.1", "sql", "local", 1, "sample_010pct", "s.parquet", 10.0),
            ],
            RUN_LOG_SCHEMA,
        )
    )


def test_default_label_and_order(log):
    got = {(r.notes, r.sample_order) for r in log.collect()}
    assert got == {("full_dataset", 3), ("sample_010pct", 0)}


def test_speedups_are_relative_to_the_slowest(log):
    got = {(r.analysis, r.technology, r.environment): r.speedup for r in runlog.speedups(log).collect()}
    assert got[("3.1", "sql", "local")] == 5.0 and got[("3.1", "hive", "local")] == 1.0
    # Runs of another environment are no measure.
    assert got[("3.1", "hive", "cluster")] == 2.0 and got[("3.1", "sql", "cluster")] == 1.0


def test_earliest_value_without_times_and_with_equal_times(spark):
    bare = [(None, "3.1", "sql", "local", f, 1.0, 1, e, 0, None) for f, e in (("b", 7.0), ("a", 9.0))]
    same = [run("3.2", "sql", "local", e, file=f) for f, e in (("b", 1), ("a", 2))]
    df = with_run_order(spark.createDataFrame([*bare, *same], RUN_LOG_SCHEMA))
    assert rows(runlog.elapsed_pivot(df, ["sql"]).orderBy("analysis")) == [("3.1", 9.0), ("3.2", 2.0)]
    assert rows(runlog.elapsed_pivot(df.orderBy("elapsed_sec"), ["sql"]).orderBy("analysis"))[1] == ("3.2", 2.0)


def test_group_figures_keep_missing_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "analysis string, elapsed_sec double")
    from pyspark.sql import functions as F

    got = runlog.with_group_figures(df, ["analysis"], slowest=F.max("elapsed_sec"))
    assert sorted(rows(got), key=str) == [("a", 2.0, 2.0), (None, 1.0, 3.0), (None, 3.0, 3.0)]


def test_compare(log):
    got = {(r.analysis, r.technology): r for r in runlog.compare_environments(log).collect()}
    hive, sql, alone = got[("3.1", "hive")], got[("3.1", "sql")], got[("3.2", "hive")]
    assert (hive.speedup, hive.tier, hive.times_slower) == (2.5, "much_faster", None)
    assert (sql.speedup, sql.tier, sql.times_slower) == (0.25, "slower", 4.0)
    assert (alone.local_sec, alone.cluster_sec, alone.tier) == (6.0, None, "missing")


def test_summary(log):
    r = runlog.compare_summary(runlog.compare_environments(log)).first()
    assert (r.mean_speedup, r.best_technology, r.worst_technology) == (1.38, "hive", "sql")


def test_pivots(log):
    local = log.where("environment = 'local'")
    assert rows(runlog.elapsed_pivot(local, ["hive", "sql"]).orderBy("analysis")) == [("3.1", 10.0, 2.0), ("3.2", 6.0, None)]
    assert rows(runlog.elapsed_matrix(local, ["3.1", "3.2"]).orderBy("technology")) == [
        ("hive", 10.0, 6.0),
        ("sql", 2.0, None),
    ]


def test_fixed_and_variable_cost(log):
    got = {r.elapsed_sec: (r.fixed_sec, r.variable_sec) for r in runlog.fixed_variable(log, "sql").collect()}
    assert got == {2.0: (0.9, 1.1), 1.0: (0.9, pytest.approx(0.1)), 8.0: (7.2, pytest.approx(0.8))}


def test_throughput_and_scalability(log):
    assert {r.throughput_k for r in runlog.throughput(log.where("elapsed_sec = 10")).collect()} == {0.1}
    assert runlog.scalability(log).first().million_rows == 0.001


def test_format_sizes(log):
    assert rows(runlog.format_sizes(log)) == [("sample_010pct", 80.0, 10.0, 8.0)]


def test_upsert(spark):
    old = spark.createDataFrame([run("3.1", "sql", "local", 5), run("3.2", "sql", "local", 6)], RUN_LOG_SCHEMA)
    new = spark.createDataFrame(
        [run("3.1", "sql", "local", 3, day=2), run("3.1", "sql", "local", 4, day=3), run("3.3", "sql", "local", 1)],
        RUN_LOG_SCHEMA,
    )
    got = {r.analysis: (r.elapsed_sec, r.action) for r in runlog.upsert(old, new).collect()}
    assert got == {"3.1": (4.0, "replaced"), "3.2": (6.0, "kept"), "3.3": (1.0, "added")}
    assert runlog.upsert(old, new).drop("action").columns == old.columns


def test_upsert_replaces_one_old_row_and_leaves_the_rest(spark):
    twice = [run("3.1", "sql", "local", 5), run("3.1", "sql", "local", 5), run("3.1", "sql", "local", 7, day=2)]
    other = [run("3.2", "sql", "local", 6), run("3.2", "sql", "local", 6)]
    old = spark.createDataFrame(twice + other, RUN_LOG_SCHEMA)
    new = spark.createDataFrame([run("3.1", "sql", "local", 1, day=3), run("3.1", "sql", "local", 2, day=3)], RUN_LOG_SCHEMA)
    got = sorted((r.analysis, r.elapsed_sec, r.action) for r in runlog.upsert(old, new).collect())
    assert got == [
        ("3.1", 2.0, "replaced"),
        ("3.1", 5.0, "kept"),
        ("3.1", 7.0, "kept"),
        ("3.2", 6.0, "kept"),
        ("3.2", 6.0, "kept"),
    ]


def test_log_file(spark, log):
    path = new_folder(spark, "log")
    write_csv(log.drop("sample_order"), path)
    back = read_run_log(spark, path, environment="cluster")
    assert back.count() == 7 and {r.environment for r in back.collect()} == {"cluster"}
    assert [r.analysis for r in back.collect()] == ["3.1"] * 6 + ["3.2"]


def test_combined(log):
    both = runlog.combined_log((log, "local"), (log, "cluster"))
    assert both.groupBy("environment").count().orderBy("environment").collect()[0]["count"] == 7


def test_lookup_and_position(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert rows(df.select(lookup("c", {"a": "A"}))) == [("A",), (None,), (None,)]
    assert rows(df.select(lookup("c", {"a": "A"}, "c"))) == [("A",), ("z",), (None,)]
    assert rows(df.select(position_in("c", ["b", "a"]), position_in("c", ["b", "a"], 99))) == [(1, 1), (None, 99), (None, 99)]
