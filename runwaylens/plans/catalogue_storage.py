"""Queries that write a table in one of the formats and answer from what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from runwaylens.operators.cleaning import clean_facts
from runwaylens.plans import reports
from runwaylens.plans.catalogue_reports import ACTIVE_LIST, AIRLINE, BY_RANK, MONTHLY, RANKING_STEPS
from runwaylens.plans.oracle import CLEANED, TYPED, missing, over, stripped
from runwaylens.plans.registry import query
from runwaylens.schema import FACT_COLUMNS, NUMBER_COLUMNS
from runwaylens.sources import conversion, inference, readers, writers
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.testviews import flights, raw_flights


@query("csv_round_trip", over("flights", "SELECT * FROM flights"))
def _(spark, sf):
    path = new_folder(spark, "csv")
    writers.write_csv(flights(spark, sf), path)
    return readers.read_fact_csv(spark, path)


@query("delimited_round_trip", over("flights", BY_RANK, **RANKING_STEPS))
def _(spark, sf):
    path = new_folder(spark, "delimited")
    report = reports.carrier_ranking(flights(spark, sf))
    writers.write_delimited(report, path)
    return spark.read.csv(path, header=True, sep="|", schema=report.schema)


FLIGHTS_AS_TEXT = f"SELECT {', '.join(f'CAST({c} AS STRING) AS {c}' for c in FACT_COLUMNS)} FROM flights"


@query(
    "raw_csv_clean",
    over("flights", "SELECT * FROM cleaned", raw=FLIGHTS_AS_TEXT, typed=TYPED, cleaned=CLEANED),
)
def _(spark, sf):
    path = new_folder(spark, "raw-csv")
    writers.write_csv(flights(spark, sf), path)
    return clean_facts(readers.read_raw_csv(spark, path))


@query("parquet_round_trip", over("flights", "SELECT * FROM flights"))
def _(spark, sf):
    path = new_folder(spark, "parquet")
    writers.write_parquet(flights(spark, sf), path)
    return readers.read_facts(spark, path)


@query(
    "partitioned_parquet_months",
    over("flights", "SELECT * FROM flights WHERE year = 1995 AND month BETWEEN 3 AND 5"),
)
def _(spark, sf):
    path = new_folder(spark, "partitioned")
    writers.write_parquet(flights(spark, sf), path, partition_by=["year", "month"])
    rows = readers.read_facts(spark, path).where((F.col("year") == 1995) & F.col("month").between(3, 5))
    return rows.select(*FACT_COLUMNS)


LINE = " || '|' || ".join(
    f"coalesce(CAST({c} AS STRING), '')" for c in ["origin", "op_unique_carrier", "month", *NUMBER_COLUMNS]
)


@query("text_round_trip", over("flights", f"SELECT {LINE} AS value FROM flights"))
def _(spark, sf):
    path = new_folder(spark, "text")
    rows = flights(spark, sf).select("origin", "op_unique_carrier", "month", *NUMBER_COLUMNS)
    writers.write_text(rows, path)
    return spark.read.text(path)


@query("array_csv_round_trip", over("flights", AIRLINE, monthly=MONTHLY, active=ACTIVE_LIST))
def _(spark, sf):
    path = new_folder(spark, "array-csv")
    report = reports.airline_stats(flights(spark, sf), months_as_text=False)
    writers.write_delimited(report, path)
    text = writers.arrays_as_text(report).schema
    back = spark.read.csv(path, header=True, sep="|", schema=text)
    return back.withColumn("months_active", F.split("months_active", ",").cast("array<int>"))


@query("table_round_trip", over("flights", BY_RANK, **RANKING_STEPS))
def _(spark, sf):
    name = f"ranking_{uuid.uuid4().hex}"
    return writers.write_table(reports.carrier_ranking(flights(spark, sf)), name, new_folder(spark, name))


@query("external_table", over("flights", "SELECT origin, count(*) AS num_flights FROM flights GROUP BY origin"))
def _(spark, sf):
    path = new_folder(spark, "external")
    writers.write_parquet(flights(spark, sf), path)
    facts = readers.external_table(spark, f"flights_{uuid.uuid4().hex}", path)
    return facts.groupBy("origin").agg(F.count(F.lit(1)).alias("num_flights"))


VIEW_SQL = """
  SELECT origin, month, count(*) AS num_flights, count(dep_delay) AS departed
  FROM {view} WHERE cancelled = 0 AND origin IS NOT NULL GROUP BY origin, month
"""


@query("temp_view_sql", over("flights", VIEW_SQL.format(view="flights")))
def _(spark, sf):
    readers.as_view(flights(spark, sf), "flights")
    return spark.sql(VIEW_SQL.format(view="flights"))


TOP_RANKING = f"SELECT * FROM ({BY_RANK}) ORDER BY origin, rank, carrier LIMIT 10"


@query("preview_top10", over("flights", TOP_RANKING, **RANKING_STEPS))
def _(spark, sf):
    return writers.preview(reports.carrier_ranking(flights(spark, sf)), ["origin", "rank", "carrier"])


@query("result_sampler", over("flights", TOP_RANKING, **RANKING_STEPS))
def _(spark, sf):
    path, out = new_folder(spark, "ranking"), new_folder(spark, "samples")
    report = reports.carrier_ranking(flights(spark, sf))
    writers.write_delimited(report, path)
    keys = ["origin", writers.numeric_key("rank"), "carrier"]
    results = {
        "analysis_3": (path, writers.REPORT_COLUMNS["analysis_3"], keys),
        "analysis_4": (f"{path}-missing", writers.REPORT_COLUMNS["analysis_3"], keys),
    }
    writers.sample_results(spark, results, out)
    return spark.read.csv(f"{out}/analysis_3", header=True, sep="|", schema=report.schema)


@query(
    "dir_convert",
    over(
        "flights",
        "SELECT month, count(*) AS num_flights, CAST(count(_bad) AS BIGINT) AS bad_rows "
        "FROM (SELECT month, CAST(NULL AS INT) AS _bad FROM flights) GROUP BY month",
    ),
)
def _(spark, sf):
    folder, out = new_folder(spark, "csv-files"), new_folder(spark, "converted")
    writers.write_csv(flights(spark, sf), folder)
    conversion.convert_csv_folders(spark, [folder, f"{folder}-missing"], out)
    return (
        spark.read.parquet(out)
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("num_flights"), F.count(readers.CORRUPT).alias("bad_rows"))
    )


@query(
    "dir_convert_status",
    over("flights", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS bad_rows FROM flights"),
)
def _(spark, sf):
    folder, out = new_folder(spark, "csv-files"), new_folder(spark, "converted")
    writers.write_csv(flights(spark, sf), folder)
    status = conversion.convert_csv_folders(spark, [folder], out)
    return status.agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))


@query(
    "input_stats",
    "SELECT 'lineitem.parquet' AS input_file, count(*) AS input_rows, true AS has_size FROM lineitem",
)
def _(spark, sf):
    stats = readers.input_stats(spark, f"{sf}/lineitem.parquet")
    return stats.select(
        F.regexp_extract("input_file", r"[^/]+$", 0).alias("input_file"),
        "input_rows",
        (F.col("input_size_mb") > 0).alias("has_size"),
    )


@query(
    "csv_input_stats",
    over("flights", "SELECT count(*) AS input_rows FROM flights"),
)
def _(spark, sf):
    path = new_folder(spark, "stats") + ".csv"
    writers.write_csv(flights(spark, sf), path)
    return readers.input_stats(spark, path).select("input_rows")


@query(
    "dir_convert_manifest",
    over(
        "flights",
        "SELECT 'converted' AS status, count(*) AS rows, true AS has_bytes, true AS own_ids FROM flights "
        "UNION ALL SELECT 'empty', 0, false, true UNION ALL SELECT 'header_only', 0, true, true",
    ),
)
def _(spark, sf):
    """Files below a path of some 400 signs, one without a byte and one with a header alone."""
    folder, out = f"{new_folder(spark, 'csv-files')}/{'long' * 50}/{'path' * 45}", new_folder(spark, "converted")
    writers.write_csv(flights(spark, sf), folder)
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, content in [("empty.csv", b""), ("header.csv", ",".join(FACT_COLUMNS).encode())]:
        stream = files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
        stream.write(bytearray(content))
        stream.close()
    status = conversion.convert_csv_folders(spark, [folder], out)
    by_status = status.groupBy("status").agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("length") > 0).alias("has_bytes"),
        (F.count_distinct("file_id") == F.count(F.lit(1))).alias("own_ids"),
    )
    return by_status


WORDY = "SELECT CASE WHEN origin LIKE 'C%' THEN 'carrier' ELSE origin END AS origin, carrier, CAST(rank AS STRING) AS rank"


@query("result_rows_header_words", over("flights", f"{WORDY} FROM ({BY_RANK})", **RANKING_STEPS))
def _(spark, sf):
    """A written report whose first column holds a header word in data rows."""
    path = new_folder(spark, "ranking")
    report = reports.carrier_ranking(flights(spark, sf))
    origin = F.when(F.col("origin").like("C%"), "carrier").otherwise(F.col("origin"))
    # The first row of each file is another one: directly below the header a header word is a header.
    first = F.when(origin == "carrier", 1).otherwise(0)
    rows = report.select(origin.alias("origin"), "carrier", "rank").coalesce(1).sortWithinPartitions(first)
    writers.write_delimited(rows, path)
    return writers.result_rows(spark, path, ["origin", "carrier", "rank"])


def _kind_sql(c: str) -> str:
    """Kind of a cell of the raw table, as the inference has it."""
    cell = stripped(missing(stripped(c)))
    return f"""CASE WHEN {cell} IS NULL THEN NULL WHEN lower({cell}) IN ('true', 'false') THEN 'flag'
      WHEN regexp_full_match({cell}, '[+-]?\\d+') AND TRY_CAST({cell} AS BIGINT) IS NOT NULL THEN 'int'
      WHEN regexp_full_match({cell}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN 'double'
      WHEN regexp_full_match({cell}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AND TRY_CAST({cell} AS DATE) IS NOT NULL THEN 'date'
      ELSE 'text' END"""


KIND_ROWS = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS \"column\", {c} AS cell, {_kind_sql(c)} AS kind FROM raw" for i, c in enumerate(FACT_COLUMNS))
# The share of cells that may not fit: dates of the raw table are bad in 1 of 37 rows.
SHARE = 0.05
INFERRED = f"""
  SELECT position, "column", type, total AS cells, missing, bad AS bad_cells,
    CASE type WHEN 'flag' THEN coalesce(l_text, l_date, l_double, l_int) WHEN 'int' THEN coalesce(l_text, l_date, l_double, l_flag)
      WHEN 'double' THEN coalesce(l_text, l_date, l_flag) WHEN 'date' THEN coalesce(l_text, l_double, l_int, l_flag) END AS bad_example
  FROM (
    SELECT *, CASE type WHEN 'flag' THEN total - n_flag WHEN 'int' THEN total - n_int WHEN 'double' THEN total - n_int - n_double
      WHEN 'date' THEN total - n_date ELSE 0 END AS bad
    FROM (
      SELECT *, CASE WHEN total = 0 THEN 'text' WHEN total - n_flag <= total * {SHARE} THEN 'flag'
        WHEN total - n_int <= total * {SHARE} THEN 'int' WHEN total - n_int - n_double <= total * {SHARE} THEN 'double'
        WHEN total - n_date <= total * {SHARE} THEN 'date' ELSE 'text' END AS type
      FROM (
        SELECT position, "column", count(kind) AS total, count(*) - count(kind) AS missing,
          {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}, min(cell) FILTER (kind = '{k}') AS l_{k}" for k in inference.KINDS)}
        FROM cells GROUP BY position, "column")))
"""


@query("csv_inferred_types", over("raw", INFERRED, cells=KIND_ROWS))
def _(spark, sf):
    return inference.with_inferred_types(raw_flights(spark, sf), SHARE).report


INFERRED_ROWS = f"""
  SELECT {", ".join(
    f"TRY_CAST(CASE WHEN ({_kind_sql(c)}) = 'int' THEN {stripped(c)} END AS BIGINT) AS {c}" if c in [*NUMBER_COLUMNS, "year", "month", "cancelled"]
    else f"TRY_CAST(CASE WHEN ({_kind_sql(c)}) = 'date' THEN {stripped(c)} END AS DATE) AS {c}" if c == "fl_date"
    else f"{missing(c)} AS {c}" for c in FACT_COLUMNS)}
  FROM raw
"""


@query("csv_inferred_rows", over("raw", INFERRED_ROWS))
def _(spark, sf):
    path = new_folder(spark, "raw-parquet")
    writers.write_parquet(raw_flights(spark, sf), path)
    return inference.with_inferred_types(spark.read.parquet(path), SHARE).rows
