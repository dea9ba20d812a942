from helpers import facts, flight, rows
from pyspark.sql import functions as F

from runwaylens.schema import FACT_SCHEMA
from runwaylens.sources import conversion, readers, writers
from runwaylens.sources.scratch import new_folder


def lines(spark, folder, name, *text):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write("\n".join(text) + "\n")
    return path


def folder(spark, label, tmp_path):
    path = tmp_path / label
    path.mkdir()
    return str(path)


HEADER = ",".join(FACT_SCHEMA.fieldNames())
GOOD = "2024-01-02,2024,1,AA,JFK,LAX,5.0,nan,0,,,,,,"


def test_typed_csv_turns_bad_cells_and_nan_into_null(spark, tmp_path):
    path = lines(spark, str(tmp_path), "a.csv", HEADER, GOOD, GOOD.replace("5.0", "NA"))
    df = readers.read_fact_csv(spark, path)
    assert df.schema == FACT_SCHEMA
    assert rows(df.select("dep_delay", "arr_delay")) == [(5.0, None), (None, None)]


def test_raw_csv_is_text_without_missing_tokens(spark, tmp_path):
    path = lines(spark, str(tmp_path), "a.csv", HEADER, GOOD)
    r = readers.read_raw_csv(spark, path).first()
    assert (r.dep_delay, r.arr_delay, r.origin) == ("5.0", None, "JFK")


def test_text_lines_keep_empty_fields(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert rows(writers.text_lines(df)) == [("a||1",)]


def test_null_text_can_be_chosen(spark):
    path = new_folder(spark, "nulls")
    df = spark.createDataFrame([("a", None)], "x string, y double")
    writers.write_delimited(df, path, null_value="NULL")
    assert {r.value for r in spark.read.text(path).collect()} == {"a|NULL", "x|y"}


def test_arrays_are_joined(spark):
    df = spark.createDataFrame([([1, 10, 2],)], "m array<int>")
    assert rows(writers.arrays_as_text(df)) == [("1,10,2",)]


def test_conversion_keeps_files_of_one_name_apart(spark, tmp_path):
    one, two = folder(spark, "x", tmp_path), folder(spark, "y z+", tmp_path)
    full = GOOD.replace("nan", "")
    paths = [
        lines(spark, one, "a.csv", HEADER, full, full),
        lines(spark, two, "a.csv", HEADER, full, full, full),
        lines(spark, one, "b c.csv", HEADER, full),
    ]
    out = new_folder(spark, "converted")
    status = conversion.convert_csv_folders(spark, [one, two], out).collect()
    got = {r.source_file.removeprefix("file:"): (r.rows, r.status) for r in status}
    assert got == dict(zip(paths, [(2, "converted"), (3, "converted"), (1, "converted")]))
    assert spark.read.parquet(out).groupBy("source_file").count().count() == 3


def test_facts_from_parquet_hold_no_nan(spark):
    path = new_folder(spark, "nan")
    spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "dep_delay double, month int").write.parquet(path)
    assert sorted(rows(readers.read_facts(spark, path)), key=repr) == [(2.0, 2), (None, 1)]


def test_positional_text_lines(spark, tmp_path):
    fields = ["2024-01-02", "2024", "1", "AA\t", "JFK", "LAX", "5", "4", "0", *[""] * 6]
    path = lines(
        spark, str(tmp_path), "p.txt", HEADER, ",".join(fields), ",".join(f if f != "JFK" else "\t" for f in fields), "\t", "a,b"
    )
    got = readers.read_positional(spark, path).collect()
    assert [(r.op_unique_carrier, r.origin, r.dep_delay) for r in got] == [("AA", "JFK", 5.0)]


def test_conversion_goes_on_after_odd_files(spark, tmp_path):
    one, two = folder(spark, "one", tmp_path), folder(spark, "two", tmp_path)
    full = GOOD.replace("nan", "")
    lines(spark, one, "a.csv", HEADER, full, full)
    lines(spark, one, "007.csv", HEADER, full, "2024-01-02,2024,one,AA")
    lines(spark, two, "empty.csv", HEADER)
    lines(spark, two, "notes.txt", "not a table")
    out = new_folder(spark, "converted")
    status = conversion.convert_csv_folders(spark, [one, two, f"{one}-absent"], out)
    got = {r.source_file.rpartition("/")[2]: (r.rows, r.bad_rows, r.status) for r in status.collect()}
    assert got == {
        "a.csv": (2, 0, "converted"),
        "007.csv": (2, 1, "converted"),
        "empty.csv": (0, 0, "header_only"),
    }
    assert spark.read.parquet(out).filter("source_file LIKE '%/a.csv'").count() == 2


def test_input_stats(spark, tmp_path):
    csv = lines(spark, str(tmp_path), "a.csv", HEADER, GOOD, GOOD)
    assert readers.input_stats(spark, csv).first().input_rows == 2
    path = new_folder(spark, "stats")
    spark.range(100000).repartition(3).write.parquet(path)
    r = readers.input_stats(spark, path).first()
    assert r.input_rows == 100000 and r.input_size_mb > 0.1
    r = readers.input_stats(spark, f"{path}-absent").first()
    assert (r.input_size_mb, r.input_rows) == (0.0, 0)


def test_result_rows_accept_old_headers_and_tabs(spark, tmp_path):
    path = lines(spark, str(tmp_path), "out.csv", "op_unique_carrier|x", "carrier|x", "AA\t1", "", "BB|10", "CC|9")
    df = writers.result_rows(spark, path, ["carrier", "n"])
    assert sorted(rows(df)) == [("AA", "1"), ("BB", "10"), ("CC", "9")]
    assert rows(writers.preview(df, [writers.numeric_key("n")], 2)) == [("AA", "1"), ("CC", "9")]


def test_sampler_reports_missing_results(spark):
    path, out = new_folder(spark, "result"), new_folder(spark, "samples")
    df = spark.range(30).select(F.col("id").alias("rank"), F.lit("x").alias("carrier"))
    writers.write_delimited(df, path)
    keys = [writers.numeric_key("rank")]
    status = writers.sample_results(
        spark, {"a": (path, df.columns, keys), "b": (f"{path}-absent", df.columns, keys)}, out
    )
    assert dict(rows(status)) == {"a": "found", "b": "missing"}
    back = spark.read.csv(f"{out}/a", header=True, sep="|")
    assert [r["rank"] for r in back.collect()] == [str(i) for i in range(10)]


def test_tables(spark):
    df = facts(spark, flight(dep=1), flight(dep=2))
    path = new_folder(spark, "external")
    writers.write_parquet(df, path)
    assert readers.external_table(spark, "facts_external", path).count() == 2
    writers.write_table(df, "facts_managed")
    writers.write_table(df.limit(1), "facts_managed")
    assert spark.table("facts_managed").count() == 1
    readers.as_view(df, "facts_view")
    assert spark.sql("SELECT max(dep_delay) AS m FROM facts_view").first().m == 2.0
    spark.sql("DROP TABLE facts_external")
    assert readers.read_facts(spark, path).count() == 2


def test_single_file_and_partitioned_layout(spark):
    df = spark.range(1000).repartition(4).withColumn("month", F.col("id") % 3)
    one, parts = new_folder(spark, "one-file"), new_folder(spark, "by-month")
    writers.write_parquet(df, one, single_file=True)
    assert len(spark.read.parquet(one).inputFiles()) == 1
    writers.write_parquet(df, parts, partition_by=["month"])
    assert spark.read.parquet(parts).where("month = 1").count() == 333
