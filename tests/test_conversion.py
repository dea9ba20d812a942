"""CSV folders to Parquet: every file accounted for, whatever its name, length or state."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from runwaylens.schema import FACT_SCHEMA
from runwaylens.sources import conversion, writers
from runwaylens.sources.scratch import new_folder

HEADER = ",".join(FACT_SCHEMA.fieldNames())
GOOD = "2024-01-02,2024,1,AA,JFK,LAX,5.0,,0,,,,,,"


def put(spark, path, text):
    """Write a file through the file system of the session, which keeps a checksum beside it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    stream.write(bytearray(text.encode()))
    stream.close()


def damage(path, at=-10):
    with open(path, "r+b") as f:
        content = f.read()
        f.seek(len(content) + at)
        f.write(b"######")


def status_of(status):
    return {r.source_file.rpartition("/")[2]: (r.rows, r.bad_rows, r.status) for r in status.collect()}


def test_a_damaged_file_is_reported_and_the_others_are_converted(spark, tmp_path):
    for name, n in [("good.csv", 40), ("bad one.csv", 3000), ("worse.csv", 1), ("last.csv", 2)]:
        put(spark, tmp_path / name, "\n".join([HEADER] + [GOOD] * n) + "\n")
    damage(tmp_path / "bad one.csv")
    damage(tmp_path / "worse.csv")
    out = new_folder(spark, "converted")
    status = conversion.convert_csv_folders(spark, [str(tmp_path)], out)
    assert status_of(status) == {
        "good.csv": (40, 0, "converted"),
        "bad one.csv": (0, 0, "failed"),
        "worse.csv": (0, 0, "failed"),
        "last.csv": (2, 0, "converted"),
    }
    reasons = {r.status: r.reason for r in status.collect()}
    assert "hecksum" in reasons["failed"] and reasons["converted"] is None
    assert spark.read.parquet(out).count() == 42


def test_empty_files_and_long_paths(spark, tmp_path):
    deep = tmp_path / ("x" * 200) / ("y" * 200) / "z+ %&é"
    deep.mkdir(parents=True)
    (deep / "empty.csv").write_text("")
    (deep / "header.csv").write_text(HEADER + "\n")
    (deep / "notes.txt").write_text("no table\n")
    (deep / f"{'n' * 200}.csv").write_text(f"{HEADER}\n{GOOD}\n2024-01-02,2024,one,AA\n")
    out = new_folder(spark, "converted")
    status = conversion.convert_csv_folders(spark, [str(deep), f"{deep}-absent"], out)
    assert status_of(status) == {
        "empty.csv": (0, 0, "empty"),
        "header.csv": (0, 0, "header_only"),
        f"{'n' * 200}.csv": (2, 1, "converted"),
    }
    ids = {r.source_file: r.file_id for r in status.collect()}
    assert len(set(ids.values())) == 3
    rows = spark.read.parquet(out).select("file_id", "source_file").distinct().collect()
    assert [(r.source_file, r.file_id) for r in rows] == [x for x in ids.items() if x[0].endswith("n.csv")]
    again = conversion.file_manifest(spark, [str(deep)])
    assert {r.source_file: r.file_id for r in again.collect()} == ids


def test_only_empty_files_or_no_folder(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    status = conversion.convert_csv_folders(spark, [str(tmp_path)], new_folder(spark, "converted"))
    assert status_of(status) == {"empty.csv": (0, 0, "empty")}
    nothing = conversion.convert_csv_folders(spark, [f"{tmp_path}-absent"], new_folder(spark, "converted"))
    assert nothing.count() == 0 and nothing.columns == status.columns


def test_errors_that_no_file_explains_are_raised(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{GOOD}\n")
    (tmp_path / "taken").write_text("a file, not a folder")
    with pytest.raises(Exception) as e:
        conversion.convert_csv_folders(spark, [str(tmp_path)], str(tmp_path / "taken" / "out"))
    assert isinstance(e.value, PySparkException) or "Py4J" in type(e.value).__name__


def test_reasons_only_for_files_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbf" + f"{HEADER}\r\n{GOOD}\r\n{GOOD}".encode())
    (tmp_path / "no_end.csv").write_text(f"{HEADER}\n\n\n{GOOD}")
    assert conversion.unreadable_files(spark, [str(tmp_path)]) == {}


def test_only_leading_header_lines_go(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\norigin|n\ncarrier|n\ncarrier|2\norigin|3\nJFK|1\n")
    (tmp_path / "b.txt").write_text("carrier|n\n")
    (tmp_path / "c.txt").write_text("LAX|9\nband|8\n")
    got = writers.result_rows(spark, str(tmp_path), ["origin", "n"]).collect()
    # Two headers lead a.txt; "carrier|2" follows them directly and cannot be told from a header.
    assert sorted(tuple(r) for r in got) == [("JFK", "1"), ("LAX", "9"), ("band", "8")]


def test_a_data_row_with_a_header_word_stays(spark):
    path = new_folder(spark, "result")
    rows = [("JFK", 1), ("carrier", 2), ("origin", 3)]
    writers.write_delimited(spark.createDataFrame(rows, "origin string, n int").coalesce(1), path)
    got = writers.result_rows(spark, path, ["origin", "n"])
    assert sorted(tuple(r) for r in got.collect()) == [(o, str(n)) for o, n in sorted(rows)]
    many = spark.range(50_000).select(F.when(F.col("id") % 9 == 8, "carrier").otherwise("x").alias("origin"), "id")
    path = new_folder(spark, "result")
    writers.write_delimited(many.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert writers.result_rows(spark, path, ["origin", "id"]).count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
