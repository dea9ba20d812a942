"""Fact, raw and run-log inputs derived from the generic test tables.

The test tables hold no flights. These views reshape order lines, suppliers, nations and
events into inputs of the right form, over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runwaylens.schema import FACT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows: one per order line, airport = supplier's nation, carrier = line flags."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k"),
    )
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("org"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sk"), F.col("s_nationkey").alias("nk"))

    g = F.col("nk") % 11
    # Some pairs rest in months 2 and 7: their lines move to the months beside them.
    away = F.when(F.month("d") == 2, -1).when(F.month("d") == 7, 1)
    moved = F.when((F.col("rf") == "A") & F.month("d").isin(2, 7), F.add_months("d", away)).otherwise(F.col("d"))
    cancelled = (F.col("k") % 53 == 0) | ((g == 3) & (F.col("rf") == "N"))
    minutes = (F.col("pk") * 37 + F.col("ok") * 11 + F.col("ln") * 13) % 200 - 40
    base = (
        lines.join(suppliers, "sk")
        .join(nations, "nk")
        .withColumn("d", moved)
        .withColumns({"g": g, "cx": cancelled, "dd": minutes})
        .withColumn("arr", F.when(~F.col("cx") & (F.col("k") % 59 != 0), F.col("dd") - 6 + (F.col("sk") * 5 + F.col("ln")) % 13))
    )

    def cause(minutes: Column) -> Column:
        return F.when(F.col("arr") >= 15, minutes.cast("double"))

    no_cause, one_cause = F.col("g") == 7, F.col("g").isin(5, 7)
    columns = {
        "fl_date": F.col("d").cast("string"),
        "year": F.year("d"),
        "month": F.month("d"),
        "op_unique_carrier": F.when(F.col("pk") % 97 != 0, F.concat("rf", "ls")),
        "origin": F.when(F.col("k") % 101 != 0, F.col("org")),
        "dest": F.concat(F.lit("NATION_"), ((F.col("nk") + F.col("ln")) % 25).cast("string")),
        "dep_delay": F.when(~F.col("cx"), F.col("dd")).cast("double"),
        "arr_delay": F.col("arr").cast("double"),
        "cancelled": F.col("cx").cast("double"),
        "cancellation_code": F.when(F.col("cx"), F.substr(F.lit("ABCD"), (F.col("pk") % 4 + 1).cast("int"), F.lit(1))),
        "carrier_delay": cause(F.when(no_cause, 0).otherwise(F.col("pk") % 40)),
        "weather_delay": cause(F.when((F.col("sk") % 7 == 0) & ~one_cause, F.col("ok") % 60).otherwise(0)),
        "nas_delay": cause(F.when(one_cause, 0).otherwise((F.col("ok") + F.col("ln")) % 35)),
        "security_delay": cause(F.when((F.col("k") % 211 == 0) & ~one_cause, 9).otherwise(0)),
        "late_aircraft_delay": cause(F.when(one_cause, 0).otherwise((F.col("pk") + F.col("sk")) % 50)),
    }
    return base.select(*[columns[c].alias(c) for c in FACT_COLUMNS])


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts as untidy text: bad dates, mixed case, padding, odd numbers, exact copies."""
    mix = F.coalesce("dep_delay", F.lit(3.0)) * 7 + F.col("month") * 13 + F.coalesce("arr_delay", F.lit(5.0)) * 3
    marked = flights(spark, sf_dir).withColumn("h", F.abs(mix).cast("int"))
    times = F.when(F.col("h") % 29 == 0, 2).otherwise(1)
    rows = marked.select(*FACT_COLUMNS, F.explode(F.array_repeat("h", times)).alias("h"))

    def hits(n: int) -> Column:
        return F.col("h") % n == 0

    def whole(c: str) -> Column:
        return F.col(c).cast("int").cast("string")

    dep = F.when(hits(41), "NA").when(hits(43), "nan").when(hits(61), "1500").when(hits(67), "-121")
    carrier = F.when(hits(5), F.lower("op_unique_carrier")).when(
        F.col("h") % 5 == 1, F.concat(F.lit("  "), "op_unique_carrier")
    )
    origin = F.when(hits(71), "\t ").when(F.col("h") % 5 == 2, F.concat(F.lit("\t"), "origin", F.lit("\n")))
    columns = {
        "fl_date": F.when(hits(37), "not a date").otherwise(F.col("fl_date")),
        "year": F.col("year").cast("string"),
        "month": F.col("month").cast("string"),
        "op_unique_carrier": carrier.otherwise(F.col("op_unique_carrier")),
        "origin": origin.otherwise(F.col("origin")),
        "dest": F.col("dest"),
        "dep_delay": dep.when(hits(73), "1440").when(hits(79), "-120").otherwise(whole("dep_delay")),
        "arr_delay": F.when(hits(47), "").when(hits(83), "2000").otherwise(whole("arr_delay")),
        "cancelled": F.when(~hits(53), whole("cancelled")),
        "cancellation_code": F.lower("cancellation_code"),
    }
    return rows.select(*[columns.get(c, whole(c)).alias(c) for c in FACT_COLUMNS])


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: the first event of every (type, user group, environment, size).

    The first event is picked by an aggregate that combines inside each task, so the many
    events of one group are never sorted together.
    """
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("analysis"),
        F.concat(F.lit("tech_"), (F.col("user_id") % 4).cast("string")).alias("technology"),
        F.when(F.floor(F.col("event_id") / 6) % 2 == 0, "local").otherwise("cluster").alias("environment"),
        (F.col("event_id") % 6).alias("sz"),
        (F.round(F.col("value") * 100) + 1).alias("elapsed_sec"),
    )
    # One combination has no run: its events count for another technology.
    gap = (F.col("analysis") == "error") & (F.col("technology") == "tech_3") & (F.col("environment") == "local")
    first = (
        events.withColumn("technology", F.when(gap, "tech_2").otherwise(F.col("technology")))
        .groupBy("analysis", "technology", "environment", "sz")
        .agg(
            F.min_by("timestamp", "event_id").alias("timestamp"), F.min_by("elapsed_sec", "event_id").alias("elapsed_sec")
        )
    )
    is_csv = F.col("technology") == "tech_0"
    size = F.col("sz") + 1
    return first.select(
        "timestamp",
        "analysis",
        "technology",
        "environment",
        F.concat(F.lit("data/sample_"), F.col("sz").cast("string"), F.when(is_csv, ".csv").otherwise(".parquet")).alias(
            "input_file"
        ),
        F.when(is_csv, size * 80).otherwise(size * 10).cast("double").alias("input_size_mb"),
        (size * 100000).alias("input_rows"),
        "elapsed_sec",
        F.lit(0).alias("exit_code"),
        F.when(F.col("sz") != 3, F.concat(F.lit("sample_"), F.col("sz").cast("string"))).alias("notes"),
    )
