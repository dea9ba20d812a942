"""Queries over the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from runwaylens.operators import profile, runlog
from runwaylens.plans.oracle import over, rounded
from runwaylens.plans.registry import query
from runwaylens.schema import RUN_KEY
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.versioned import current_path, current_version, replace_table
from runwaylens.sources.readers import with_run_order
from runwaylens.sources.testviews import runs

# The sizes and groups of the derived run log.
SIZES = ["sample_0", "sample_1", "sample_2", "full_dataset", "sample_4", "sample_5"]
TECHNOLOGIES = ["tech_0", "tech_1", "tech_2", "tech_3"]
ANALYSES = ["click", "error", "purchase", "signup", "view"]

POSITION = f"CAST(nullif(list_position({SIZES}, notes), 0) - 1 AS INT)"
EARLIEST = "(timestamp IS NULL, timestamp, analysis, technology, environment, input_file, elapsed_sec)"
FULL = "SELECT * FROM runs WHERE notes = 'full_dataset'"


def log(spark, sf):
    return with_run_order(runs(spark, sf), SIZES)


@query(
    "runlog_load",
    over(
        "runs",
        "SELECT analysis, technology, environment, input_file, input_size_mb, input_rows, elapsed_sec, exit_code, "
        f"notes, {POSITION} AS sample_order FROM runs",
    ),
)
def _(spark, sf):
    return log(spark, sf).drop("timestamp").orderBy("analysis", "technology", "sample_order")


def _pivot(row: str, column: str, values: list[str]) -> str:
    picks = ", ".join(
        f"arg_min(elapsed_sec, {EARLIEST}) FILTER (WHERE {column} = '{v}') AS \"{v}\"" for v in values
    )
    return over("runs", f"SELECT {row}, {picks} FROM runs WHERE notes = 'full_dataset' GROUP BY {row}")


@query("runlog_pivot", _pivot("analysis", "technology", TECHNOLOGIES))
def _(spark, sf):
    return runlog.elapsed_pivot(log(spark, sf), TECHNOLOGIES)


@query("runlog_matrix", _pivot("technology", "analysis", ANALYSES))
def _(spark, sf):
    return runlog.elapsed_matrix(log(spark, sf), ANALYSES)


@query("runlog_labels", over("runs", "SELECT DISTINCT notes FROM runs"))
def _(spark, sf):
    return profile.distinct_values(log(spark, sf), "notes")


@query(
    "runlog_first_size",
    over("runs", "SELECT notes, arg_min(input_size_mb, (timestamp, input_file)) AS first_mb FROM runs GROUP BY notes"),
)
def _(spark, sf):
    earliest = F.min_by("input_size_mb", F.struct("timestamp", "input_file"))
    return log(spark, sf).groupBy("notes").agg(earliest.alias("first_mb"))


@query(
    "runlog_speedup",
    over(
        "runs",
        "SELECT analysis, technology, environment, elapsed_sec, "
        "max(elapsed_sec) OVER (PARTITION BY analysis, environment) / elapsed_sec AS speedup FROM full_runs",
        full_runs=FULL,
    ),
)
def _(spark, sf):
    return runlog.speedups(log(spark, sf))


@query(
    "runlog_throughput",
    over(
        "runs",
        "SELECT analysis, technology, environment, input_rows, elapsed_sec, "
        "input_rows / elapsed_sec / 1000 AS throughput_k FROM full_runs",
        full_runs=FULL,
    ),
)
def _(spark, sf):
    return runlog.throughput(log(spark, sf))


@query(
    "runlog_fixed_variable",
    over(
        "runs",
        f"""
        SELECT analysis, environment, notes, {POSITION} AS sample_order, elapsed_sec, fixed_sec,
          greatest(elapsed_sec - fixed_sec, 0.0) AS variable_sec
        FROM (SELECT *, min(elapsed_sec) OVER (PARTITION BY analysis, environment) * CAST(0.9 AS DOUBLE) AS fixed_sec
              FROM runs WHERE technology = 'tech_1')
        """,
    ),
)
def _(spark, sf):
    return runlog.fixed_variable(log(spark, sf), "tech_1")


@query(
    "runlog_scalability",
    over(
        "runs",
        f"SELECT analysis, technology, environment, notes, {POSITION} AS sample_order, "
        "CAST(input_rows AS DOUBLE) / 1000000.0 AS million_rows, elapsed_sec FROM runs",
    ),
)
def _(spark, sf):
    return runlog.scalability(log(spark, sf))


def _side(env: str) -> str:
    return (
        f"SELECT analysis, technology, arg_min(elapsed_sec, {EARLIEST}) AS {env}_sec FROM full_runs "
        f"WHERE environment = '{env}' GROUP BY ALL"
    )


COMPARED = f"""
  SELECT analysis, technology, local_sec, cluster_sec, speedup,
    CASE WHEN speedup IS NULL THEN 'missing' WHEN speedup >= 2 THEN 'much_faster' WHEN speedup >= 1 THEN 'faster'
      ELSE 'slower' END AS tier,
    CASE WHEN speedup < 1 THEN {rounded("CASE WHEN speedup > 0 THEN 1.0 / speedup END", 1)} END AS times_slower
  FROM (SELECT *, {rounded("local_sec / cluster_sec", 2)} AS speedup
        FROM (SELECT * FROM l FULL JOIN c USING (analysis, technology)))
"""
COMPARE_STEPS = {"full_runs": FULL, "l": _side("local"), "c": _side("cluster"), "compared": COMPARED}


@query("runlog_compare", over("runs", "SELECT * FROM compared", **COMPARE_STEPS))
def _(spark, sf):
    return runlog.compare_environments(log(spark, sf))


@query(
    "runlog_compare_summary",
    over(
        "runs",
        f"""
        SELECT {rounded("avg(speedup)", 2)} AS mean_speedup, max(speedup) AS best_speedup,
          max_by(analysis, (speedup, analysis, technology)) AS best_analysis,
          max_by(technology, (speedup, analysis, technology)) AS best_technology,
          min(speedup) AS worst_speedup,
          min_by(analysis, (speedup, analysis, technology)) AS worst_analysis,
          min_by(technology, (speedup, analysis, technology)) AS worst_technology
        FROM compared WHERE speedup IS NOT NULL
        """,
        **COMPARE_STEPS,
    ),
)
def _(spark, sf):
    return runlog.compare_summary(runlog.compare_environments(log(spark, sf)))


def _sizes(suffix: str) -> str:
    return (
        f"SELECT notes, arg_min(input_size_mb, {EARLIEST.replace("elapsed_sec", "input_size_mb")}) AS {suffix}_mb FROM runs "
        f"WHERE input_file LIKE '%.{suffix}' GROUP BY notes"
    )


@query(
    "runlog_format_sizes",
    over(
        "runs",
        "SELECT notes, csv_mb, parquet_mb, csv_mb / parquet_mb AS ratio FROM a JOIN b USING (notes)",
        a=_sizes("csv"),
        b=_sizes("parquet"),
    ),
)
def _(spark, sf):
    return runlog.format_sizes(log(spark, sf), SIZES)


@query(
    "runlog_common_labels",
    over(
        "runs",
        "SELECT notes FROM runs WHERE input_file LIKE '%.csv' INTERSECT "
        "SELECT notes FROM runs WHERE input_file LIKE '%.parquet'",
    ),
)
def _(spark, sf):
    rows = log(spark, sf)
    csv = rows.where(F.col("input_file").endswith(".csv")).select("notes")
    return csv.intersect(rows.where(F.col("input_file").endswith(".parquet")).select("notes"))


@query(
    "runlog_combined",
    over(
        "runs",
        "SELECT analysis, technology, 'local' AS environment, input_file, elapsed_sec FROM runs "
        "WHERE environment = 'local' UNION ALL "
        "SELECT analysis, technology, 'cluster', input_file, elapsed_sec FROM runs WHERE environment = 'cluster'",
    ),
)
def _(spark, sf):
    rows = log(spark, sf).select("analysis", "technology", "environment", "input_file", "elapsed_sec")
    return runlog.combined_log(
        (rows.where(F.col("environment") == "local"), "local"),
        (rows.where(F.col("environment") == "cluster"), "cluster"),
    )


UPDATES = """
  SELECT timestamp + INTERVAL 1 DAY AS timestamp, analysis, technology,
    CASE WHEN technology = 'tech_2' THEN 'cloud' ELSE environment END AS environment, input_file,
    elapsed_sec + 1 AS elapsed_sec FROM runs WHERE technology IN ('tech_1', 'tech_2')
"""
UPSERTED = """
  SELECT analysis, technology, environment, input_file, elapsed_sec,
    CASE WHEN NOT any_new THEN 'kept' WHEN all_new THEN 'added' ELSE 'replaced' END AS action
  FROM (
    SELECT *, row_number() OVER (PARTITION BY analysis, technology, environment, input_file
                                 ORDER BY is_new DESC, timestamp DESC, elapsed_sec DESC) AS rn,
      bool_or(is_new) OVER (PARTITION BY analysis, technology, environment, input_file) AS any_new,
      bool_and(is_new) OVER (PARTITION BY analysis, technology, environment, input_file) AS all_new
    FROM (
      SELECT timestamp, analysis, technology, environment, input_file, elapsed_sec, false AS is_new FROM runs
      UNION ALL SELECT *, true FROM updates
    )
  ) WHERE rn = 1
"""


@query("runlog_upsert", over("runs", UPSERTED, updates=UPDATES))
def _(spark, sf):
    old = log(spark, sf).select("timestamp", *RUN_KEY, "elapsed_sec")
    return runlog.upsert(old, later_runs(old)).drop("timestamp")


def later_runs(old):
    """Newer runs of some of the keys, and runs in an environment of their own."""
    return (
        old.where(F.col("technology").isin("tech_1", "tech_2"))
        .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
        .withColumn("elapsed_sec", F.col("elapsed_sec") + 1)
        .withColumn("environment", F.when(F.col("technology") == "tech_2", "cloud").otherwise(F.col("environment")))
    )


SAVED = f"SELECT analysis, technology, environment, input_file, elapsed_sec FROM ({UPSERTED})"


@query("runlog_saved_in_place", over("runs", SAVED, updates=UPDATES))
def _(spark, sf):
    """The log is saved, and the log with newer runs is saved onto it twice."""
    table = new_folder(spark, "run-log")

    def write(rows, path):
        rows.write.parquet(path)

    first = log(spark, sf).select("timestamp", *RUN_KEY, "elapsed_sec")
    replace_table(spark, table, first, write)
    for _ in range(2):
        version = current_version(spark, table)
        old = spark.read.parquet(current_path(spark, table))
        replace_table(spark, table, runlog.upsert(old, later_runs(first)).drop("action"), write, version)
    return spark.read.parquet(current_path(spark, table)).drop("timestamp")
