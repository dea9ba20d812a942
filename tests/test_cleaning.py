from helpers import raw, rows

from runwaylens.functions import strip_upper, to_date_text, to_number
from runwaylens.operators import cleaning
from runwaylens.operators.cleaning import clean_facts, cleaning_report, drop_blank_keys, select_present
from runwaylens.schema import FACT_COLUMNS
from runwaylens.sources.readers import normalise_missing, parse_positional, read_raw_csv
from runwaylens.sources.scratch import new_folder

BASE = {"fl_date": "2024-01-02", "year": "2024", "month": "1", "op_unique_carrier": "AA", "origin": "JFK"}


def test_range_limits(spark):
    delays = ["-121", "-120", "1440", "1441", None]
    df = clean_facts(raw(spark, *[BASE | {"dep_delay": d} for d in delays]))
    assert sorted(rows(df.select("dep_delay")), key=str) == sorted([(-120.0,), (1440.0,), (None,)], key=str)


def test_blank_key_survives_as_empty_text(spark):
    df = clean_facts(raw(spark, BASE | {"origin": "  "}))
    assert rows(df.select("origin")) == [("",)]
    assert drop_blank_keys(df, ["origin"]).count() == 0


def test_missing_keys_and_bad_dates_are_dropped(spark):
    bad = [{"fl_date": "soon"}, {"op_unique_carrier": None}, {"origin": "NA"}, {"origin": ""}]
    assert clean_facts(raw(spark, *[BASE | b for b in bad])).count() == 0


def test_copies_with_missing_cells_are_one_row(spark):
    assert clean_facts(raw(spark, BASE, BASE, BASE | {"origin": "\tjfk\n"})).count() == 1


def test_flags_and_numbers(spark):
    cells = [BASE | {"cancelled": c, "nas_delay": n} for c, n in [(None, "nan"), ("1.0", "x"), ("0", "7")]]
    got = {(r.cancelled, r.nas_delay) for r in clean_facts(raw(spark, *cells)).collect()}
    assert got == {(0, None), (1, None), (0, 7.0)}


def test_optional_columns_may_be_absent(spark):
    df = raw(spark, BASE | {"dep_delay": "5"}).drop("nas_delay", "security_delay")
    assert clean_facts(df).first().dep_delay == 5.0
    assert select_present(df, ["origin", "nas_delay"]).columns == ["origin"]


def test_report_adds_up(spark):
    cells = [BASE, BASE, BASE | {"dep_delay": "9999"}, BASE | {"arr_delay": "-500"}, BASE | {"origin": None}]
    got = dict(rows(cleaning_report(raw(spark, *cells))))
    assert got["rows_in"] == 5 and got["rows_out"] == 1
    removed = sum(v for k, v in got.items() if k.startswith("removed_"))
    assert got["rows_in"] - removed == got["rows_out"]
    assert got["nulls_dep_delay"] == 1 and got["nulls_origin"] == 0


def test_report_of_nothing(spark):
    got = dict(rows(cleaning_report(raw(spark, BASE).limit(0))))
    assert got["rows_in"] == got["rows_out"] == got["removed_duplicates"] == 0


def test_scalar_cleaning(spark):
    df = spark.createDataFrame([("\x0b ab ",), ("NaN",), ("2024-02-30",), ("1e3",)], "c string")
    got = rows(df.select(strip_upper("c"), to_number("c"), to_date_text("c")))
    assert got == [("AB", None, None), ("NAN", None, None), ("2024-02-30", None, None), ("1E3", 1000.0, None)]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("n/a", 2), ("NAN", 3), (None, 4)], "c string, i int")
    assert rows(normalise_missing(df)) == [(None, 1), (None, 2), ("NAN", 3), (None, 4)]


def test_positional_lines(spark):
    good = "2024-01-02,2024,1, AA ,JFK,LAX,5,NA,0,,,,,,"
    lines = [
        "fl_date,year,month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled,x,x,x,x,x,x",
        good,
        "",
        "   ",
        "2024-01-02,2024,1,AA",
        "2024-01-02,2024,1,,JFK,LAX,5,1,0,,,,,,",
        "2024-01-02,2024,1,AA,JFK,LAX,late,1,0,,,,,,",
        good + ",one more field",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    strict = parse_positional(df)
    assert rows(strict.select("op_unique_carrier", "dep_delay", "arr_delay", "cancelled")) == [("AA", 5.0, None, 0.0)] * 2
    lenient = parse_positional(df, drop_bad_numbers=False)
    assert sorted(rows(lenient.select("dep_delay")), key=str) == [(5.0,), (5.0,), (None,)]


def test_dates_in_other_forms(spark):
    forms = ["2024-1-5", "2024-01-05 00:00:00", "1/5/2024", "1/5/2024 12:00:00 AM", "2024/01/05", "20240105", " 2024-01-05\t"]
    bad = ["2024", "13/45/2024", "soon", "", None]
    df = spark.createDataFrame([(f,) for f in forms + bad], "d string")
    got = [r[0] for r in df.select(to_date_text("d")).collect()]
    assert got == ["2024-01-05"] * len(forms) + [None] * len(bad)
    own = spark.createDataFrame([("05.01.24",)], "d string").select(to_date_text("d", ["dd.MM.yy"])).first()[0]
    assert own == "2024-01-05"


def test_keys_of_white_space_only(spark):
    df = spark.createDataFrame([("\t", "JFK"), ("AA", " \r"), ("AA", "JFK\t")], "a string, b string")
    assert rows(drop_blank_keys(df, ["a", "b"])) == [("AA", "JFK\t")]


def test_rows_in_another_date_form_survive_cleaning(spark):
    text = raw(spark, *[{"fl_date": d, "op_unique_carrier": "AA", "origin": "JFK", "month": "1"} for d in ("1/5/2024", "2024-1-6")])
    assert sorted(r.fl_date for r in clean_facts(text).collect()) == ["2024-01-05", "2024-01-06"]


def test_report_and_rows_come_from_one_scan(spark, tmp_path):
    """The raw file is gone once the cleaned rows are written, and the report is still whole."""
    path = tmp_path / "raw.csv"
    row = "{},2024,1,{},JFK,LAX,{},,0,,,,,,"
    lines = [row.format("2024|01|02", " aa", "5.0")] * 3 + [row.format("2024|01|03", "BB", "2000"), row.format("2024|01|03", "", "1")]
    lines += [row.format("2024-01-09", "cc", "x"), row.format("9|9", "DD", "1")]
    path.write_text("\n".join([",".join(FACT_COLUMNS), *lines]) + "\n")
    table, out = read_raw_csv(spark, str(path)), new_folder(spark, "cleaned")
    want = {r.metric: r.value for r in cleaning.cleaning_report(table, ["yyyy|MM|dd"]).collect()}
    want_rows = sorted(rows(cleaning.clean_facts(table, ["yyyy|MM|dd"])), key=repr)

    def write(cleaned):
        cleaned.write.parquet(out)
        path.unlink()

    report = {r.metric: r.value for r in cleaning.write_cleaned(table, write, ["yyyy|MM|dd"]).collect()}
    assert report == want and sorted(rows(spark.read.parquet(out)), key=repr) == want_rows
    assert {k: report[k] for k in ("rows_in", "removed_missing_key", "removed_dep_delay_out_of_range", "removed_duplicates", "rows_out")} == {
        "rows_in": 7, "removed_missing_key": 2, "removed_dep_delay_out_of_range": 1, "removed_duplicates": 2, "rows_out": 2,
    }
    # Without the own form the dates are unknown.
    path.write_text("\n".join([",".join(FACT_COLUMNS), *lines]) + "\n")
    other = {r.metric: r.value for r in cleaning.cleaning_report(read_raw_csv(spark, str(path))).collect()}
    assert other["rows_out"] == 1


def test_report_on_an_empty_table(spark):
    out = new_folder(spark, "cleaned")
    empty = raw(spark, {"origin": "x"}).limit(0)
    report = {r.metric: r.value for r in cleaning.write_cleaned(empty, lambda df: df.write.parquet(out)).collect()}
    assert report["rows_in"] == report["rows_out"] == 0 and report["columns_out"] == len(FACT_COLUMNS)
