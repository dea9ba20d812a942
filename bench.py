"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (folder of the test tables), BENCH_CPUS (local cores), BENCH_FACT_ROWS
(rows of the larger fact table on which the three reports are timed from Parquet to delimited
text; 0 leaves that part out).
"""

from __future__ import annotations

import json
import math
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.operators import cleaning, grouping, profile, sampling
from runwaylens.plans import reports
from runwaylens.plans.catalogue import QUERIES
from runwaylens.sources import inference
from runwaylens.sources.readers import read_facts
from runwaylens.sources.testviews import flights, raw_flights
from runwaylens.sources.writers import write_delimited

HEADLINE = [
    "airline_stats",
    "delay_report",
    "carrier_ranking",
    "carrier_airport_grouping_sets",
    "clean_flights",
    "clean_metrics",
    "null_profile",
    "duplicate_profile",
    "describe_delays",
    "delay_histogram",
    "value_counts_carrier",
    "top20_airports_by_delay",
    "sample_exact",
    "sample_oversize",
    "runlog_speedup",
    "runlog_compare",
    "runlog_upsert",
]
REPORTS = {
    "airline_stats": reports.airline_stats,
    "delay_report": reports.delay_report,
    "carrier_ranking": reports.carrier_ranking,
}
# Operators over stored views of the test tables, without the joins that make the views.
STORED = {
    "airline_stats": lambda facts, raw: reports.airline_stats(facts),
    "airline_stats_joined": lambda facts, raw: reports.airline_stats_joined(facts),
    "delay_report": lambda facts, raw: reports.delay_report(facts),
    "delay_report_joined": lambda facts, raw: reports.delay_report_joined(facts),
    "carrier_ranking": lambda facts, raw: reports.carrier_ranking(facts),
    "carrier_ranking_joined": lambda facts, raw: reports.carrier_ranking_joined(facts),
    "union_all_causes": lambda facts, raw: grouping.cause_means_union(facts),
    "describe": lambda facts, raw: profile.describe(facts),
    "duplicate_profile": lambda facts, raw: profile.duplicate_profile(facts),
    "null_profile": lambda facts, raw: profile.null_profile(facts),
    "sample_exact": lambda facts, raw: sampling.sample_exact(facts, 0.25, fixed_order=True),
    "sample_oversize": lambda facts, raw: sampling.oversample_exact(facts, 1.25, fixed_order=True),
    "clean_facts": lambda facts, raw: cleaning.clean_facts(raw),
    "cleaning_report": lambda facts, raw: cleaning.cleaning_report(raw),
    "inferred_types": lambda facts, raw: inference.with_inferred_types(raw).report,
}
REPEATS = 3


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    """Median of several runs after one run that warms the JVM."""
    action()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def time_reports(spark: SparkSession, sf_dir: str, rows: int, scratch: str) -> dict:
    """The reports over a fact table of at least ``rows`` rows, copied up from the test tables."""
    facts = flights(spark, sf_dir)
    copies = math.ceil(rows / facts.count())
    path = f"{scratch}/facts"
    many = facts.repartition(16).select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    many.drop("copy").write.parquet(path)
    out = {"rows": read_facts(spark, path).count(), "queries": {}}
    for name, report in REPORTS.items():
        target = f"{scratch}/out-{name}"
        took = seconds(lambda: write_delimited(report(read_facts(spark, path)), target, single_file=True))
        out["queries"][name] = took
    out["rows_per_sec"] = {name: round(out["rows"] / s) for name, s in out["queries"].items()}
    return out


def time_stored(spark: SparkSession, sf_dir: str, scratch: str) -> dict:
    """Operators over Parquet copies of the views."""
    for name, view in (("flights", flights), ("raw", raw_flights)):
        view(spark, sf_dir).repartition(8).write.parquet(f"{scratch}/stored-{name}")
    facts, raw = read_facts(spark, f"{scratch}/stored-flights"), spark.read.parquet(f"{scratch}/stored-raw")
    return {name: seconds(lambda: run(make(facts, raw))) for name, make in STORED.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_FACT_ROWS", "7038851"))
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        spark = session(cpus, scratch)
        times = {name: seconds(lambda: run(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
        result = {
            "metric": "headline queries, total of medians",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": float(Path(sf_dir).name.removeprefix("sf")),
        }
        result["on_stored_views"] = time_stored(spark, sf_dir, scratch)
        if rows:
            result["reports_on_fact_table"] = time_reports(spark, sf_dir, rows, scratch)
        spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
