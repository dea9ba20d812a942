"""Queries that profile the fact table and the raw table."""

from __future__ import annotations

from pyspark.sql import functions as F

from runwaylens.operators.full_profile import full_profile
from runwaylens.operators import cleaning, profile
from runwaylens.plans.catalogue_cleaning import describe_sql
from runwaylens.plans.oracle import missing, over, rounded
from runwaylens.plans.registry import SQL, query
from runwaylens.schema import FACT_COLUMNS, MONTH_LABELS, NUMBER_COLUMNS
from runwaylens.sources.readers import normalise_missing
from runwaylens.sources.testviews import flights, raw_flights, table


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    return profile.row_count(table(spark, sf, "lineitem"))


def _nulls(source: str) -> str:
    pct = rounded("null_count * 100.0 / all_rows", 2)
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS all_rows "
        f"FROM {source}"
        for c in FACT_COLUMNS
    )
    return f'SELECT "column", null_count, {pct} AS null_pct FROM ({parts})'


@query("null_profile", over("flights", _nulls("flights")))
def _(spark, sf):
    return profile.null_profile(flights(spark, sf))


NO_TOKENS = f"SELECT {', '.join(f'{missing(c)} AS {c}' for c in FACT_COLUMNS)} FROM raw"


@query("null_profile_raw", over("raw", _nulls("told"), told=NO_TOKENS))
def _(spark, sf):
    return profile.null_profile(normalise_missing(raw_flights(spark, sf)))


@query(
    "duplicate_profile",
    over(
        "raw",
        f"SELECT rows, duplicates, {rounded('duplicates * 100.0 / rows', 3)} AS duplicate_pct FROM "
        "(SELECT (SELECT count(*) FROM raw) AS rows, "
        "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicates)",
    ),
)
def _(spark, sf):
    return profile.duplicate_profile(raw_flights(spark, sf))


@query("describe_delays", over("flights", " UNION ALL ".join(describe_sql("flights", c) for c in NUMBER_COLUMNS)))
def _(spark, sf):
    return profile.describe(flights(spark, sf))


FIGURES = ["column", "count", "mean", "std", "min", "max"]


@query(
    "describe_delays_sketch",
    over(
        "flights",
        "SELECT \"column\", count, mean, std, min, max, true AS quartiles_near FROM ("
        + " UNION ALL ".join(describe_sql("flights", c) for c in NUMBER_COLUMNS)
        + ")",
    ),
)
def _(spark, sf):
    df = flights(spark, sf)
    exact = profile.describe(df).select("column", F.array("p25", "p50", "p75").alias("exact"))
    sketch = profile.describe(df, exact=False).withColumn("sketch", F.array("p25", "p50", "p75"))
    off = F.zip_with("sketch", "exact", lambda a, b: F.abs(a - b))
    return sketch.join(exact, "column").select(*FIGURES, (F.array_max(off) <= 1).alias("quartiles_near"))


def _labelled(dataset: str, source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{dataset}' AS dataset FROM ({describe_sql(source, c)})" for c in columns
    )


@query(
    "describe_before_after",
    over("cleaned", _labelled("raw", "typed", NUMBER_COLUMNS[:2]) + " UNION ALL "
         + _labelled("cleaned", "cleaned", NUMBER_COLUMNS[:2])),
)
def _(spark, sf):
    raw = raw_flights(spark, sf)
    return profile.describe_before_after(cleaning.typed_facts(raw), cleaning.clean_facts(raw))


@query(
    "scalar_stats",
    over(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max, {rounded(f'avg({c})', 1)} AS mean, "
            f"{rounded(f'stddev_samp({c})', 1)} AS std FROM flights"
            for c in NUMBER_COLUMNS[:2]
        ),
    ),
)
def _(spark, sf):
    return profile.scalar_stats(flights(spark, sf), NUMBER_COLUMNS[:2])


def _counts(column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM flights WHERE {column} IS NOT NULL GROUP BY {column}"


@query("value_counts_carrier", over("flights", _counts("op_unique_carrier")))
def _(spark, sf):
    return profile.value_counts(flights(spark, sf), "op_unique_carrier")


@query("value_counts_month", over("flights", _counts("month")))
def _(spark, sf):
    return profile.value_counts(flights(spark, sf), "month", by_value=True)


@query(
    "value_counts_cancel_codes",
    over(
        "flights",
        "SELECT CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'NAS' "
        "WHEN 'D' THEN 'Security' END AS cause, count(*) AS count FROM flights "
        "WHERE cancellation_code IN ('A', 'B', 'C', 'D') GROUP BY 1",
    ),
)
def _(spark, sf):
    return profile.cancellation_causes(flights(spark, sf))


@query("distinct_carriers", over("flights", "SELECT DISTINCT op_unique_carrier FROM flights"))
def _(spark, sf):
    return profile.distinct_values(flights(spark, sf), "op_unique_carrier")


@query(
    "cancel_share",
    over(
        "flights",
        f"""
        SELECT count(*) FILTER (WHERE cancelled = 1) AS flagged,
          {rounded("count(*) FILTER (WHERE cancelled = 1) * 100.0 / count(*)", 2)} AS flagged_pct,
          count(*) FILTER (WHERE cancelled = 0) AS clear FROM flights
        """,
    ),
)
def _(spark, sf):
    return profile.flag_share(flights(spark, sf))


@query(
    "cancel_rate_by_carrier",
    over(
        "flights",
        "SELECT op_unique_carrier, avg(cancelled) * 100 AS flag_pct FROM flights "
        "WHERE op_unique_carrier IS NOT NULL GROUP BY 1",
    ),
)
def _(spark, sf):
    return profile.flag_rate_by(flights(spark, sf), "op_unique_carrier")


MEANS = ", ".join(f"{rounded(f'avg({c})', 2)} AS avg_{c}" for c in NUMBER_COLUMNS[:2])


@query(
    "avg_delay_by_carrier",
    over(
        "flights",
        f"SELECT op_unique_carrier, {MEANS} FROM flights WHERE op_unique_carrier IS NOT NULL GROUP BY 1",
    ),
)
def _(spark, sf):
    return profile.means_by_entity(flights(spark, sf))


@query(
    "avg_delay_by_month",
    over(
        "flights",
        f"SELECT month, {MEANS}, {MONTH_LABELS}[month] AS month_label FROM flights WHERE month IS NOT NULL "
        "GROUP BY month",
    ),
)
def _(spark, sf):
    return profile.means_by_month(flights(spark, sf))


@query(
    "mean_and_count_by_airport",
    over(
        "flights",
        "SELECT origin, avg(dep_delay) AS mean, count(dep_delay) AS count FROM flights WHERE origin IS NOT NULL GROUP BY 1",
    ),
)
def _(spark, sf):
    return profile.mean_and_count(flights(spark, sf))


@query(
    "top20_airports_by_delay",
    over(
        "flights",
        "SELECT origin, avg(dep_delay) AS mean, count(dep_delay) AS count FROM flights WHERE origin IS NOT NULL "
        "GROUP BY 1 HAVING count(dep_delay) >= 1000 ORDER BY mean DESC, origin LIMIT 20",
    ),
)
def _(spark, sf):
    return profile.top_by_mean(flights(spark, sf))


@query(
    "top20_airports_by_count",
    over(
        "flights",
        "SELECT origin, count(*) AS count FROM flights WHERE origin IS NOT NULL GROUP BY 1 "
        "ORDER BY count DESC, origin LIMIT 20",
    ),
)
def _(spark, sf):
    return profile.top_by_count(flights(spark, sf))


def _histogram(c: str, lo: float, hi: float, bins: int) -> str:
    return f"""
      SELECT '{c}' AS "column", b.bin, {rounded("e.lo + b.bin * e.w", 4)} AS bin_start, coalesce(n.count, 0) AS count
      FROM (SELECT CAST(range AS INT) AS bin FROM range({bins})) b
      JOIN (SELECT lo, (hi - lo) / {bins} AS w FROM (
        SELECT greatest(least(min({c}), {hi}), {lo}) AS lo, greatest(least(max({c}), {hi}), {lo}) AS hi FROM flights
      )) e ON true
      LEFT JOIN (
        SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin, count(*) AS count
        FROM (SELECT greatest(least({c}, {hi}), {lo}) AS v FROM flights WHERE {c} IS NOT NULL) JOIN (
          SELECT greatest(least(min({c}), {hi}), {lo}) AS lo, greatest(least(max({c}), {hi}), {lo}) AS hi FROM flights
        ) ON true GROUP BY 1
      ) n ON n.bin = b.bin
    """


def _histograms(lo: float, hi: float, bins: int) -> str:
    return over("flights", " UNION ALL ".join(_histogram(c, lo, hi, bins) for c in NUMBER_COLUMNS[:2]))


@query("delay_histogram", _histograms(-60.0, 300.0, 80))
def _(spark, sf):
    return profile.histogram(flights(spark, sf))


@query("delay_histogram_narrow", _histograms(-30.0, 130.0, 64))
def _(spark, sf):
    return profile.histogram(flights(spark, sf), limits=(-30.0, 130.0), bins=64)


def _metrics(source: str) -> str:
    return f"""
      SELECT CAST(count(*) AS DOUBLE) AS rows, CAST({len(FACT_COLUMNS)} AS DOUBLE) AS columns,
        CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS DOUBLE) AS duplicates,
        CAST(count(*) FILTER (WHERE dep_delay IS NULL) AS DOUBLE) AS missing_dep_delay,
        coalesce(sum(TRY_CAST(cancelled AS DOUBLE)), 0.0) AS total_cancelled FROM {source}
    """


@query(
    "before_after",
    over(
        "cleaned",
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, r.{m} AS raw, c.{m} AS cleaned FROM r JOIN c ON true"
            for m in ["rows", "columns", "duplicates", "missing_dep_delay", "total_cancelled"]
        ),
        told=NO_TOKENS,
        r=_metrics("told"),
        c=_metrics("cleaned"),
    ),
)
def _(spark, sf):
    raw = normalise_missing(raw_flights(spark, sf))
    return profile.before_after(raw, cleaning.clean_facts(raw))


def _shared(name: str, part: str, single: str) -> None:
    """A table of the profile of three scans; the SQL is that of the single figure."""

    @query(name, SQL[single])
    def _(spark, sf):
        return full_profile(flights(spark, sf))[part]


_shared("shared_profile_nulls", "nulls", "null_profile")
_shared("shared_profile_histogram", "histogram", "delay_histogram")
_shared("shared_profile_top_by_delay", "top_by_delay", "top20_airports_by_delay")
