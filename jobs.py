"""Command line for spark-submit: clean, convert, sample, report, profile and compare runs.

    spark-submit jobs.py clean raw.csv cleaned.parquet
    spark-submit jobs.py delay-report cleaned.parquet out --single-file
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.operators import runlog
from runwaylens.operators.cleaning import write_cleaned
from runwaylens.operators.full_profile import full_profile
from runwaylens.operators.sampling import write_sample_suite
from runwaylens.plans import reports
from runwaylens.schema import DATE_FORMATS, FACT_SCHEMA, RUN_LOG_SCHEMA, SAMPLE_FRACTIONS
from runwaylens.sources.conversion import convert_csv_folders
from runwaylens.sources.readers import read_fact_csv, read_facts, read_raw_csv, read_run_log
from runwaylens.sources.versioned import current_path, current_version, replace_table
from runwaylens.sources.writers import (
    REPORT_COLUMNS,
    numeric_key,
    preview,
    sample_results,
    write_csv,
    write_delimited,
    write_parquet,
)

REPORTS = {
    "airline-stats": reports.airline_stats,
    "delay-report": reports.delay_report,
    "carrier-ranking": reports.carrier_ranking,
}
# Sort keys of the written reports; months and ranks are text when read back.
SAMPLE_KEYS = {
    "analysis_1": ["carrier", "origin", "month"],
    "analysis_2": ["origin", "month", "delay_band"],
    "analysis_3": ["origin", "rank", "carrier"],
}
NUMERIC_KEYS = {"month", "rank"}
PREVIEWS = {"airline-stats": "analysis_1", "delay-report": "analysis_2", "carrier-ranking": "analysis_3"}


def load(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned facts from Parquet, or from CSV where the path says so."""
    return read_fact_csv(spark, path) if path.rstrip("/").endswith(".csv") else read_facts(spark, path)


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    def write(cleaned: DataFrame) -> None:
        write_csv(cleaned, a.output) if a.output.endswith(".csv") else write_parquet(as_facts(cleaned), a.output)

    report = write_cleaned(read_raw_csv(spark, a.input), write, a.date_formats)
    if a.report:
        write_delimited(report, a.report, single_file=True)


def as_facts(df: DataFrame) -> DataFrame:
    """The columns in the storage types of the fact table."""
    types = {f.name: f.dataType for f in FACT_SCHEMA}
    return df.select(*[df[c].cast(types[c]).alias(c) for c in df.columns])


def convert(spark: SparkSession, a: argparse.Namespace) -> None:
    status = convert_csv_folders(spark, a.folders, a.output)
    write_delimited(status, f"{a.output.rstrip('/')}_status")
    # A glance only; the whole status is in the written table.
    spark.read.csv(f"{a.output.rstrip('/')}_status", header=True, sep="|").orderBy("source_file").show(truncate=False)


def sample(spark: SparkSession, a: argparse.Namespace) -> None:
    manifest = write_sample_suite(spark, a.input, a.output, a.fractions, exact=not a.fast)
    write_delimited(manifest, f"{a.output.rstrip('/')}/manifest", single_file=True)
    manifest.show(len(a.fractions), truncate=False)


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    write_delimited(REPORTS[a.job](load(spark, a.input)), a.output, single_file=a.single_file)
    # The preview reads what was written, so the report is not computed again, and sorts it anew.
    written = spark.read.csv(a.output, header=True, sep="|")
    preview(written, sort_keys(PREVIEWS[a.job])).show(10, truncate=False)


def profiles(spark: SparkSession, a: argparse.Namespace) -> None:
    for name, part in full_profile(load(spark, a.input)).items():
        write_delimited(part, f"{a.output}/{name}")


def compare(spark: SparkSession, a: argparse.Namespace) -> None:
    logs = [(read_run_log(spark, current_path(spark, path)), env) for path, env in ((a.local, "local"), (a.cluster, "cluster"))]
    runs = runlog.combined_log(*logs)
    compared = runlog.compare_environments(runs)
    parts = {
        "compare": compared.orderBy("analysis", "technology"),
        "summary": runlog.compare_summary(compared),
        "speedups": runlog.speedups(runs),
        "throughput": runlog.throughput(runs),
        "scalability": runlog.scalability(runs),
    }
    small = {}
    for (log, env), technologies, analyses in [(x, names(x[0], "technology"), names(x[0], "analysis")) for x in logs]:
        small[f"format_sizes_{env}"] = runlog.format_sizes(log)
        small[f"pivot_{env}"] = runlog.elapsed_pivot(log, technologies)
        small[f"matrix_{env}"] = runlog.elapsed_matrix(log, analyses)
        for technology in technologies:
            parts[f"fixed_variable_{env}/{technology}"] = runlog.fixed_variable(with_environment(log, env), technology)
    for name, part in parts.items():
        write_delimited(part, f"{a.output}/{name}", single_file=a.single_file)
    for name, part in small.items():
        write_delimited(part, f"{a.output}/{name}", single_file=True)


def names(runs: DataFrame, column: str) -> list[str]:
    """The few names in a key column of a run log, which become columns or folders."""
    return [r[0] for r in runs.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]


def sort_keys(name: str) -> list:
    return [numeric_key(k) if k in NUMERIC_KEYS else k for k in SAMPLE_KEYS[name]]


def save_runs(spark: SparkSession, a: argparse.Namespace) -> None:
    """The log with new runs added or put in place of old ones.

    Written to ``output``, a table of versions, which may be the log itself: the old version is there until the new one
    is whole.
    """
    old = spark.read.csv(current_path(spark, a.log), header=True, schema=RUN_LOG_SCHEMA)
    new = spark.read.csv(a.new, header=True, schema=RUN_LOG_SCHEMA)
    version = current_version(spark, a.output)
    merged = runlog.upsert(with_environment(old, a.environment), with_environment(new, a.environment))
    replace_table(spark, a.output, merged.drop("action"), write_csv, version)


def with_environment(runs: DataFrame, environment: str) -> DataFrame:
    """Runs that name no environment belong to the given one."""
    return runs.withColumn("environment", F.coalesce("environment", F.lit(environment)))


def sample_results_job(spark: SparkSession, a: argparse.Namespace) -> None:
    """First rows of each written report, given as analysis_N=path."""
    chosen = dict(entry.split("=", 1) for entry in a.results)
    results = {}
    for name, path in chosen.items():
        results[name] = (path, REPORT_COLUMNS[name], sort_keys(name))
    status = sample_results(spark, results, a.output)
    write_delimited(status, f"{a.output.rstrip('/')}/status", single_file=True)
    status.show(len(results), truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = p.add_subparsers(dest="job", required=True)

    def add(name: str, run, *paths: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name)
        for path in paths:
            job.add_argument(path)
        job.set_defaults(run=run)
        return job

    job = add("clean", clean, "input", "output")
    job.add_argument("--report", help="folder for the counts per rule")
    job.add_argument("--date-formats", nargs="+", default=DATE_FORMATS, help="forms of dates other than year-month-day")
    job = add("convert", convert, "output")
    job.add_argument("folders", nargs="+")
    job = add("sample", sample, "input", "output")
    job.add_argument("--fractions", nargs="+", type=float, default=SAMPLE_FRACTIONS)
    job.add_argument("--fast", action="store_true", help="approximate sizes, no counting passes")
    for name in REPORTS:
        add(name, report, "input", "output").add_argument("--single-file", action="store_true")
    add("sample-results", sample_results_job, "output").add_argument("results", nargs="+")
    add("profile", profiles, "input", "output")
    add("compare-runs", compare, "local", "cluster", "output").add_argument("--single-file", action="store_true")
    add("save-runs", save_runs, "log", "new", "output").add_argument("--environment", default="local")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"runwaylens {args.job}").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
