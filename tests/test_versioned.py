"""Tables of versions: in place, whole before and after, and safe against a writer that dies or is late."""

import os

import pytest

import jobs
from runwaylens.sources import versioned
from runwaylens.sources.scratch import new_folder


def parquet(df, path):
    df.write.parquet(path)


def rows(spark, table):
    return sorted(tuple(r) for r in spark.read.parquet(versioned.current_path(spark, table)).collect())


def test_a_table_is_replaced_by_rows_made_from_itself(spark):
    table = new_folder(spark, "versions")
    versioned.replace_table(spark, table, spark.range(3), parquet)
    for n in (4, 5, 6):
        version = versioned.current_version(spark, table)
        old = spark.read.parquet(versioned.current_path(spark, table))
        versioned.replace_table(spark, table, old.union(spark.range(n - 1, n)), parquet, version)
        assert rows(spark, table) == [(i,) for i in range(n)]
    names = os.listdir(table.removeprefix("file:"))
    assert sum(n.startswith("v-") for n in names) == 2 and sum(n == versioned.POINTER for n in names) == 1
    # A reader that started on the version before still finds it.
    assert spark.read.parquet(f"{table}/{version}").count() == 5


def test_a_writer_that_dies_leaves_the_old_version(spark):
    table = new_folder(spark, "versions")
    versioned.replace_table(spark, table, spark.range(3), parquet)
    version = versioned.current_version(spark, table)

    def dies(df, path):
        parquet(df, path)
        raise OSError("no more space")

    with pytest.raises(OSError):
        versioned.replace_table(spark, table, spark.range(9), dies, version)
    assert rows(spark, table) == [(0,), (1,), (2,)]
    versioned.replace_table(spark, table, spark.range(1), parquet, version)
    assert rows(spark, table) == [(0,)] and len([n for n in os.listdir(table) if n.startswith("v-")]) == 2


def test_a_late_writer_is_refused(spark):
    table = new_folder(spark, "versions")
    versioned.replace_table(spark, table, spark.range(1), parquet)
    version = versioned.current_version(spark, table)
    versioned.replace_table(spark, table, spark.range(2), parquet, version)
    with pytest.raises(versioned.ChangedMeanwhile):
        versioned.replace_table(spark, table, spark.range(3), parquet, version)
    assert rows(spark, table) == [(0,), (1,)]


def test_plain_folders_are_read_but_not_replaced(spark):
    plain = new_folder(spark, "plain")
    spark.range(2).write.parquet(plain)
    assert versioned.current_path(spark, plain) == plain and versioned.current_version(spark, plain) is None
    with pytest.raises(ValueError):
        versioned.replace_table(spark, plain, spark.range(1), parquet)
    assert spark.read.parquet(plain).count() == 2


def test_runs_are_saved_onto_the_same_log(spark, tmp_path):
    header = "timestamp,analysis,technology,environment,input_file,input_size_mb,input_rows,elapsed_sec,exit_code,notes"
    first, later, log = tmp_path / "first.csv", tmp_path / "later.csv", str(tmp_path / "log")
    run = "2024-01-0{},{},spark,local,a.csv,1.0,10,{},0,full"
    first.write_text("\n".join([header, run.format(1, "one", 5.0), run.format(1, "two", 6.0)]) + "\n")
    later.write_text("\n".join([header, run.format(2, "two", 4.0), run.format(2, "three", 9.0)]) + "\n")
    jobs.main(["save-runs", str(first), str(later), log])
    jobs.main(["save-runs", log, str(later), log])
    got = spark.read.csv(versioned.current_path(spark, log), header=True)
    assert sorted((r.analysis, float(r.elapsed_sec)) for r in got.collect()) == [("one", 5.0), ("three", 9.0), ("two", 4.0)]
