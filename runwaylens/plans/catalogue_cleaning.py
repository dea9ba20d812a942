"""Queries for cleaning, malformed input and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from runwaylens.functions import strip_upper
from runwaylens.operators import cleaning, profile, sampling
from runwaylens.plans.oracle import ARR_OK, DEP_OK, HAS_KEYS, NORMALISED, missing, number, over, rounded, stripped
from runwaylens.plans.registry import query
from runwaylens.schema import FACT_COLUMNS, NUMBER_COLUMNS, SAMPLE_FRACTIONS
from runwaylens.sources.readers import parse_positional
from runwaylens.sources.scratch import new_folder
from runwaylens.sources.testviews import flights, raw_flights, table
from runwaylens.sources.writers import write_parquet


@query("clean_flights", over("cleaned", "SELECT * FROM cleaned"))
def _(spark, sf):
    return cleaning.clean_facts(raw_flights(spark, sf))


METRICS = {
    "rows_in": "SELECT count(*) FROM typed",
    "removed_missing_key": f"SELECT count(*) FROM typed WHERE NOT ({HAS_KEYS})",
    "removed_dep_delay_out_of_range": f"SELECT count(*) FROM typed WHERE {HAS_KEYS} AND NOT {DEP_OK}",
    "removed_arr_delay_out_of_range": f"SELECT count(*) FROM typed WHERE {HAS_KEYS} AND {DEP_OK} AND NOT {ARR_OK}",
    "removed_duplicates": "SELECT (SELECT count(*) FROM kept) - (SELECT count(*) FROM cleaned)",
    "rows_out": "SELECT count(*) FROM cleaned",
    "columns_out": f"SELECT CAST({len(FACT_COLUMNS)} AS BIGINT)",
} | {f"nulls_{c}": f"SELECT count(*) FROM cleaned WHERE {c} IS NULL" for c in FACT_COLUMNS}
KEPT = f"SELECT {NORMALISED} FROM typed WHERE {HAS_KEYS} AND {DEP_OK} AND {ARR_OK}"


@query(
    "clean_metrics",
    over(
        "cleaned",
        " UNION ALL ".join(f"SELECT '{m}' AS metric, ({sql}) AS value" for m, sql in METRICS.items()),
        kept=KEPT,
    ),
)
def _(spark, sf):
    return cleaning.cleaning_report(raw_flights(spark, sf))


CLEAN_REPORT = " UNION ALL ".join(f"SELECT '{m}' AS metric, ({sql}) AS value" for m, sql in METRICS.items())


@query("clean_write_report", over("cleaned", CLEAN_REPORT, kept=KEPT))
def _(spark, sf):
    path = new_folder(spark, "cleaned")
    return cleaning.write_cleaned(raw_flights(spark, sf), lambda rows: write_parquet(rows, path))


@query("clean_write_rows", over("cleaned", "SELECT * FROM cleaned"))
def _(spark, sf):
    path = new_folder(spark, "cleaned")
    cleaning.write_cleaned(raw_flights(spark, sf), lambda rows: write_parquet(rows, path))
    return spark.read.parquet(path)


@query("clean_write_own_dates", over("cleaned", CLEAN_REPORT, kept=KEPT))
def _(spark, sf):
    """The same figures where the dates are written in a form that only the caller knows."""
    path = new_folder(spark, "cleaned")
    raw = raw_flights(spark, sf).withColumn("fl_date", F.translate("fl_date", "-", "|"))
    return cleaning.write_cleaned(raw, lambda rows: write_parquet(rows, path), ["yyyy|MM|dd"])


@query("typed_rows", over("typed", "SELECT * FROM typed"))
def _(spark, sf):
    return cleaning.typed_facts(raw_flights(spark, sf))


@query("drop_missing_keys", over("typed", f"SELECT * FROM typed WHERE {HAS_KEYS}"))
def _(spark, sf):
    return cleaning.drop_missing_keys(cleaning.typed_facts(raw_flights(spark, sf)))


@query("keep_delay_range", over("typed", f"SELECT * FROM typed WHERE {DEP_OK} AND {ARR_OK}"))
def _(spark, sf):
    return cleaning.keep_delay_range(cleaning.typed_facts(raw_flights(spark, sf)))


@query("normalise_codes", over("typed", f"SELECT {NORMALISED} FROM typed"))
def _(spark, sf):
    return cleaning.normalise_codes(cleaning.typed_facts(raw_flights(spark, sf)))


@query(
    "blank_key_skip",
    over("raw", f"SELECT * FROM raw WHERE length({stripped('op_unique_carrier')}) > 0 AND length({stripped('origin')}) > 0"),
)
def _(spark, sf):
    return cleaning.drop_blank_keys(raw_flights(spark, sf), ["op_unique_carrier", "origin"])


OUTLIER_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, {c} AS minutes FROM typed WHERE {c} < -120 OR {c} > 1440" for c in NUMBER_COLUMNS[:2]
)


@query("outlier_rows", over("typed", OUTLIER_ROWS))
def _(spark, sf):
    rows = cleaning.typed_facts(raw_flights(spark, sf))
    parts = [
        cleaning.outliers(rows, c).select(F.lit(c).alias("measure"), F.col(c).alias("minutes"))
        for c in NUMBER_COLUMNS[:2]
    ]
    return parts[0].unionByName(parts[1])


def describe_sql(source: str, column: str) -> str:
    """Figures of one column of a table, as ``describe`` gives them."""
    stats = {
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "p25": f"quantile_cont({column}, 0.25)",
        "p50": f"quantile_cont({column}, 0.5)",
        "p75": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})",
    }
    figures = ", ".join(f"{rounded(sql, 2)} AS {name}" for name, sql in stats.items())
    return f'SELECT \'{column}\' AS "column", count({column}) AS count, {figures} FROM {source} HAVING count({column}) > 0'


@query(
    "outliers_described",
    over(
        "typed",
        " UNION ALL ".join(
            describe_sql(f"(SELECT {c} FROM typed WHERE {c} < -120 OR {c} > 1440)", c) for c in NUMBER_COLUMNS[:2]
        ),
    ),
)
def _(spark, sf):
    rows = cleaning.typed_facts(raw_flights(spark, sf))
    parts = [profile.describe(cleaning.outliers(rows, c), [c]) for c in NUMBER_COLUMNS[:2]]
    return parts[0].unionByName(parts[1])


# Comma lines made of the fact rows: header, blank, short and non-numeric lines mixed in.
LINE_FIELDS = ["year", "month", "cancelled", *NUMBER_COLUMNS]
SQL_LINE = " || ',' || ".join(
    f"coalesce(CAST(CAST({c} AS INT) AS STRING), '')"
    if c in LINE_FIELDS and c != "dep_delay"
    else "dep_text"
    if c == "dep_delay"
    else f"coalesce({c}, '')"
    for c in FACT_COLUMNS
)
SQL_LINES = f"""
  SELECT CASE WHEN h % 97 = 0 THEN '{",".join(FACT_COLUMNS)}' WHEN h % 89 = 0 THEN '   '
      WHEN h % 83 = 0 THEN fl_date || ',' || 'short' ELSE line END AS value
  FROM (
    SELECT h, fl_date, {SQL_LINE} AS line FROM (
      SELECT *, CASE WHEN h % 79 = 0 THEN 'late' WHEN h % 73 = 0 THEN 'NA' ELSE
        coalesce(CAST(CAST(dep_delay AS INT) AS STRING), '') END AS dep_text
      FROM (SELECT *, CAST(abs(coalesce(dep_delay, 3) * 7 + month * 13) AS INT) AS h FROM flights)
    )
  )
"""


def _sql_cell(i: int, c: str) -> str:
    cell = stripped(f"f[{i + 1}]")
    if c in NUMBER_COLUMNS or c == "cancelled":
        return f"{number(cell)} AS {c}"
    if c in ("year", "month"):
        return f"TRY_CAST({missing(cell)} AS INT) AS {c}"
    return f"{missing(cell)} AS {c}"


def _sql_numeric(i: int) -> str:
    cell = stripped(f"f[{i + 1}]")
    return f"(({missing(cell)}) IS NULL OR TRY_CAST({cell} AS DOUBLE) IS NOT NULL)"


MALFORMED = f"""
  SELECT {", ".join(_sql_cell(i, c) for i, c in enumerate(FACT_COLUMNS))}
  FROM (SELECT string_split({stripped('value')}, ',') AS f FROM lines)
  WHERE len(f) >= 15 AND f[1] <> 'fl_date' AND {stripped('f[3]')} NOT IN ('month', '') AND {stripped('f[4]')} <> '' AND {stripped('f[5]')} <> ''
    AND {_sql_numeric(6)} AND {_sql_numeric(7)} AND {_sql_numeric(8)}
"""


def comma_lines(df):
    """Fact rows as comma lines, some of them replaced by lines that no reader should accept."""
    h = F.abs(F.coalesce("dep_delay", F.lit(3.0)) * 7 + F.col("month") * 13).cast("int")

    def whole(c):
        return F.coalesce(F.col(c).cast("int").cast("string"), F.lit(""))

    dep = F.when(F.col("h") % 79 == 0, "late").when(F.col("h") % 73 == 0, "NA").otherwise(whole("dep_delay"))
    cells = [
        dep if c == "dep_delay" else whole(c) if c in LINE_FIELDS else F.coalesce(c, F.lit("")) for c in FACT_COLUMNS
    ]
    line = (
        F.when(F.col("h") % 97 == 0, ",".join(FACT_COLUMNS))
        .when(F.col("h") % 89 == 0, "   ")
        .when(F.col("h") % 83 == 0, F.concat_ws(",", "fl_date", F.lit("short")))
        .otherwise(F.concat_ws(",", *cells))
    )
    return df.withColumn("h", h).select(line.alias("value"))


@query("malformed_rows", over("flights", MALFORMED, lines=SQL_LINES))
def _(spark, sf):
    return parse_positional(comma_lines(flights(spark, sf)))


@query(
    "strip_upper_codes",
    over(
        "raw",
        "SELECT upper(regexp_replace(origin, '^\\s+|\\s+$', '', 'g')) AS origin, count(*) AS num_rows "
        "FROM raw GROUP BY 1",
    ),
)
def _(spark, sf):
    return (
        raw_flights(spark, sf).groupBy(strip_upper("origin").alias("origin")).agg(F.count(F.lit(1)).alias("num_rows"))
    )


@query(
    "distinct_rows",
    over("raw", "SELECT DISTINCT * FROM raw"),
)
def _(spark, sf):
    return raw_flights(spark, sf).distinct()


@query(
    "sample_exact",
    "SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY md5('42|' || o_orderkey)) "
    "<= (SELECT round_even(0.25 * count(*), 0) FROM orders)",
)
def _(spark, sf):
    return sampling.sample_exact(table(spark, sf, "orders"), 0.25, key=["o_orderkey"])


@query(
    "sample_exact_by_position",
    "SELECT CAST(round_even(0.1 * count(*), 0) AS BIGINT) AS num_rows, "
    "CAST(round_even(0.1 * count(*), 0) AS BIGINT) AS keys FROM orders",
)
def _(spark, sf):
    picked = sampling.sample_exact(table(spark, sf, "orders"), 0.1, fixed_order=True)
    per_key = picked.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("num_rows"), F.count(F.lit(1)).alias("keys"))


@query(
    "sample_oversize",
    "SELECT count(*) + CAST(floor(count(*) * 0.25) AS BIGINT) AS num_rows, count(DISTINCT o_orderkey) AS keys "
    "FROM orders",
)
def _(spark, sf):
    picked = sampling.oversample_exact(table(spark, sf, "orders"), 1.25, fixed_order=True)
    per_key = picked.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("num_rows"), F.count(F.lit(1)).alias("keys"))


def _size_check(picked, whole, fraction: float):
    """Whether an approximate sample has about the right size, and how many distinct keys it may hold."""
    n = whole.agg(F.count(F.lit(1))).scalar()
    keys = whole.select("o_orderkey").withColumn("times", F.lit(0))
    both = keys.unionByName(picked.select("o_orderkey").withColumn("times", F.lit(1)))
    per_key = both.groupBy("o_orderkey").agg(F.sum("times").alias("times"))
    total = F.sum("times")
    # Six standard deviations of the number of rows drawn at random.
    near = F.abs(total - n * F.lit(fraction)) < 6 * F.sqrt(n)
    return per_key.agg(F.count(F.lit(1)).alias("keys"), near.alias("near"), F.min("times").alias("fewest"))


@query(
    "sample_bernoulli",
    "SELECT count(*) AS keys, true AS near, CAST(0 AS BIGINT) AS fewest FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return _size_check(sampling.sample_fraction(orders, 0.25), orders, 0.25)


@query(
    "sample_poisson_oversize",
    "SELECT count(*) AS keys, true AS near, CAST(1 AS BIGINT) AS fewest FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return _size_check(sampling.sample_fraction(orders, 1.25), orders, 1.25)


def _expected_rows(fraction: float) -> str:
    if fraction <= 1:
        return f"CAST(round_even({fraction} * count(*), 0) AS BIGINT)"
    return f"count(*) + CAST(floor(count(*) * {fraction - 1}) AS BIGINT)"


@query(
    "sample_suite",
    " UNION ALL ".join(
        f"SELECT '{sampling.sample_name(f)}' AS name, CAST({f} AS DOUBLE) AS fraction, "
        f"{_expected_rows(f)} AS rows FROM orders"
        for f in SAMPLE_FRACTIONS
    ),
)
def _(spark, sf):
    out = new_folder(spark, "samples")
    return sampling.write_sample_suite(spark, f"{sf}/orders.parquet", out).drop("size_mb")
