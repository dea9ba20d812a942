"""Inferred column types against a plain reading of the rules."""

import re
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runwaylens.schema import FACT_COLUMNS, MISSING_TOKENS
from runwaylens.sources.inference import KINDS, TYPES, cell_kind, inferred_types, kind_counts, read_inferred_csv, typed_cell, with_inferred_types


def kind(cell):
    if cell is None or cell.strip() in MISSING_TOKENS:
        return None
    cell = cell.strip()
    if cell.lower() in ("true", "false"):
        return "flag"
    if re.fullmatch(r"[+-]?\d+", cell) and -(1 << 63) <= int(cell) < 1 << 63:
        return "int"
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", cell) or re.fullmatch(r"[+-]?inf(inity)?", cell.lower()):
        return "double"
    if m := re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", cell):
        try:
            date(*map(int, m.groups()))
            return "date"
        except ValueError:
            pass
    return "text"


def brute(cells, tolerance):
    kinds = [k for c in cells if (k := kind(c))]
    for name, (held, _) in TYPES.items():
        bad = sum(k not in held for k in kinds)
        if kinds and bad <= len(kinds) * tolerance:
            return name, bad
    return "text", 0


CELLS = ["1", "-7", "+3", "007", "2.5", "1e3", ".5", "inf", "true", "False", "2024-01-31", "2024-02-30", "x", "NA", "", " 4 ", None, "9" * 25]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(CELLS), min_size=3, max_size=3), min_size=1, max_size=12), st.sampled_from([0.0, 0.2, 0.5]))
def test_types_equal_brute_force(spark, table, tolerance):
    df = spark.createDataFrame(table, "a string, b string, c string")
    report = inferred_types(kind_counts(df), tolerance).collect()
    got = [(r.type, r.bad_cells) for r in sorted(report, key=lambda r: r.position)]
    assert got == [brute([row[i] for row in table], tolerance) for i in range(3)]


def test_counts_of_parts_add_up(spark):
    rows = [(str(i) if i % 10 else "2.5", CELLS[i % len(CELLS)]) for i in range(300)]
    whole = spark.createDataFrame(rows, "a string, b string")
    parts = [kind_counts(spark.createDataFrame(rows[i::3], "a string, b string")).collect() for i in range(3)]
    for i, r in enumerate(kind_counts(whole).orderBy("at").collect()):
        for k in [*KINDS, "missing"]:
            assert r[k] == sum(next(x for x in p if x.at == i)[k] for p in parts)


def test_one_bad_cell_is_reported(spark, tmp_path):
    """A bad cell among many leaves the type; missing tokens decide nothing; a second header line is no number."""
    lines = ["n,x,day,ok,code,none", *[f"{i},{i / 4},2024-01-{i % 28 + 1},true,A{i},NA" for i in range(400)]]
    lines[7], lines[8], lines[9] = "n,x,day,ok,code,none", "NA,nan,,null,N/A,", "oops,1,2024-13-01,false,z,NULL"
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    found = read_inferred_csv(spark, str(tmp_path / "a.csv"))
    assert found.rows.dtypes == [("n", "bigint"), ("x", "double"), ("day", "date"), ("ok", "boolean"), ("code", "string"), ("none", "string")]
    report = {r.column: r for r in found.report.collect()}
    assert [report[c].bad_cells for c in found.rows.columns] == [2, 1, 2, 1, 0, 0]
    assert (report["n"].bad_example, report["day"].bad_example, report["ok"].bad_example) == ("n", "2024-13-01", "ok")
    assert (report["none"].cells, report["none"].type, report["code"].missing) == (1, "text", 1)
    assert found.rows.filter("n is null").count() == 3 and found.rows.agg({"x": "max"}).first()[0] == 399 / 4
    strict = read_inferred_csv(spark, str(tmp_path / "a.csv"), tolerance=0)
    assert {t for _, t in strict.rows.dtypes} == {"string"}


def test_one_scan_whatever_the_columns(spark):
    df = spark.createDataFrame([tuple("1" for _ in FACT_COLUMNS)], ", ".join(f"{c} string" for c in FACT_COLUMNS))
    found = with_inferred_types(df.withColumn("a.b", df.year).withColumn("n", df.year.cast("int")))
    assert found.rows.schema["a.b"].dataType.simpleString() == "bigint" and dict(found.rows.dtypes)["n"] == "int"
    empty = with_inferred_types(df.limit(0))
    assert {t for _, t in empty.rows.dtypes} == {"string"} and empty.report.filter("cells = 0").count() == len(FACT_COLUMNS)


def test_a_kind_is_worked_out_once_for_each_different_cell(spark):
    """Equal cells are counted before their kind is asked for, and a typed cell is what its kind says."""
    df = spark.createDataFrame([(CELLS[i % 18], f" {CELLS[i % 7]}\t") for i in range(400)], "a string, b string")
    plan = kind_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"keys=\[at#\d+, cell#\d+\]", plan)
    for name, (held, storage) in list(TYPES.items())[:4]:
        got = df.select(typed_cell(F.col("a"), name).alias("x"), F.when(cell_kind(F.col("a")).isin(*held), F.trim("a")).try_cast(storage).alias("y"))
        assert got.filter("not (x <=> y)").count() == 0
