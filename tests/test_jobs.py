"""The command line, end to end: raw CSV to cleaned facts, samples, reports and profiles."""

import pytest

import jobs
from runwaylens.schema import FACT_COLUMNS, FACT_SCHEMA
from runwaylens.sources.readers import read_fact_csv
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.testviews import flights, runs
from runwaylens.sources.writers import write_csv

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cleaned(spark):
    raw, out = new_folder(spark, "job-raw"), new_folder(spark, "job-clean")
    write_csv(flights(spark, DATA), raw)
    jobs.main(["clean", raw, out, "--report", f"{out}-report"])
    return out


def test_clean(spark, cleaned):
    df = spark.read.parquet(cleaned)
    assert df.schema == FACT_SCHEMA
    report = {r.metric: int(r.value) for r in spark.read.csv(f"{cleaned}-report", header=True, sep="|").collect()}
    assert report["rows_out"] == df.count() and report["rows_in"] == flights(spark, DATA).count()


def test_clean_to_csv(spark):
    raw, out = new_folder(spark, "job-raw"), new_folder(spark, "job-clean") + ".csv"
    write_csv(flights(spark, DATA), raw)
    jobs.main(["clean", raw, out])
    assert read_fact_csv(spark, out).columns == FACT_COLUMNS


@pytest.mark.parametrize("name", sorted(jobs.REPORTS))
def test_reports(spark, cleaned, name):
    out = new_folder(spark, name)
    jobs.main([name, cleaned, out, "--single-file"])
    back = spark.read.csv(out, header=True, sep="|")
    assert back.count() == jobs.REPORTS[name](spark.read.parquet(cleaned)).count() > 0


def test_result_samples(spark, cleaned):
    report, out = new_folder(spark, "job-report"), new_folder(spark, "job-result-samples")
    jobs.main(["airline-stats", cleaned, report])
    jobs.main(["sample-results", out, f"analysis_1={report}", f"analysis_3={report}-absent"])
    got = spark.read.csv(f"{out}/analysis_1", header=True, sep="|").collect()
    want = jobs.REPORTS["airline-stats"](spark.read.parquet(cleaned)).limit(10).collect()
    assert [(r.carrier, r.origin, r.month) for r in got] == [(r.carrier, r.origin, str(r.month)) for r in want]


def test_convert_and_sample(spark, cleaned):
    folder, out = new_folder(spark, "job-csv"), new_folder(spark, "job-out")
    write_csv(spark.read.parquet(cleaned), folder)
    jobs.main(["convert", f"{out}-parquet", folder])
    n = spark.read.parquet(cleaned).count()
    assert spark.read.parquet(f"{out}-parquet").count() == n
    jobs.main(["sample", cleaned, f"{out}-samples", "--fractions", "0.5", "1.25"])
    assert spark.read.parquet(f"{out}-samples/sample_050pct").count() == round(n * 0.5)
    assert spark.read.parquet(f"{out}-samples/sample_125pct").count() == n + int(n * 0.25)


def test_profile(spark, cleaned):
    out = new_folder(spark, "job-profile")
    jobs.main(["profile", cleaned, out])
    assert spark.read.csv(f"{out}/describe", header=True, sep="|").count() == 7
    assert spark.read.csv(f"{out}/nulls", header=True, sep="|").count() == len(FACT_COLUMNS)


def test_compare_runs(spark):
    path, out = new_folder(spark, "job-runs"), new_folder(spark, "job-compare")
    log = runs(spark, DATA)
    for env in ("local", "cluster"):
        write_csv(log.where(log.environment == env), f"{path}-{env}")
    jobs.main(["compare-runs", f"{path}-local", f"{path}-cluster", out])
    compared = spark.read.csv(f"{out}/compare", header=True, sep="|")
    assert compared.count() > 0 and "speedup" in compared.columns
