"""Scans: raw and typed CSV, positional text, Parquet, tables, run logs, and input statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.functions import missing_to_null, nan_to_null, position_in, strip_text, to_number
from runwaylens.schema import (
    FACT_COLUMNS,
    FACT_SCHEMA,
    FULL_LABEL,
    RUN_LOG_SCHEMA,
    SAMPLE_ORDER,
)

CORRUPT = "_corrupt_record"
MEGABYTE = 1024 * 1024


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def normalise_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL for every missing-value token in the given columns, by default all text columns."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    text = text if columns is None else text & set(columns)
    return df.select(*[missing_to_null(c).alias(c) if c in text else c for c in df.columns])


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headered CSV as text columns, missing-value tokens already NULL.

    No type inference: it would cost a second pass, and one bad cell would turn a
    whole column into text.
    """
    return normalise_missing(spark.read.option("header", True).csv(path))


def without_nan(df: DataFrame) -> DataFrame:
    """NULL for NaN in the DOUBLE columns."""
    numbers = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[nan_to_null(c).alias(c) if c in numbers else F.col(c) for c in df.columns])


def read_fact_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = FACT_SCHEMA) -> DataFrame:
    """Headered CSV with the declared schema; bad cells are NULL, and so is NaN."""
    return without_nan(spark.read.csv(path, header=True, schema=schema))


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Fact rows from Parquet; NaN, which other tools write for a missing number, becomes NULL."""
    return without_nan(spark.read.parquet(path))


def parse_positional(
    lines: DataFrame,
    columns: Sequence[str] = tuple(FACT_COLUMNS),
    required: Sequence[str] = ("op_unique_carrier", "origin", "month"),
    numbers: Sequence[str] = ("dep_delay", "arr_delay", "cancelled"),
    drop_bad_numbers: bool = True,
) -> DataFrame:
    """Fields of comma lines (column ``value``) by position; the split knows no quotes.

    Blank lines, header lines, short lines and lines with an empty required field
    are skipped. A number that cannot be parsed drops its line, or becomes NULL
    when ``drop_bad_numbers`` is off.
    """
    # Exploding a one-element array makes the split a column of its own: the conditions
    # below then read it instead of each splitting the line again.
    split_once = F.explode(F.array(F.split(strip_text("value"), ","))).alias("fields")
    month_at = list(columns).index("month") if "month" in columns else 0
    kept = (
        lines.select(split_once)
        .where(F.size("fields") >= len(columns))
        .where((F.get("fields", 0) != columns[0]) & (strip_text(F.get("fields", month_at)) != "month"))
    )
    text = kept.select(*[strip_text(F.get("fields", i)).alias(c) for i, c in enumerate(columns)])
    for c in (c for c in required if c in columns):
        text = text.where(F.length(c) > 0)
    if drop_bad_numbers:
        for c in numbers:
            text = text.where(missing_to_null(c).isNull() | F.col(c).try_cast("double").isNotNull())
    types = {f.name: f.dataType.simpleString() for f in FACT_SCHEMA}
    return text.select(
        *[
            to_number(c).alias(c)
            if types.get(c) == "double"
            else missing_to_null(c).try_cast(types.get(c, "string")).alias(c)
            for c in columns
        ]
    )


def read_positional(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return parse_positional(spark.read.text(path), **options)


def external_table(spark: SparkSession, name: str, path: str, schema: T.StructType = FACT_SCHEMA) -> DataFrame:
    """Table over an existing Parquet folder; dropping the table leaves the files."""
    return spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def as_view(df: DataFrame, name: str = "flights") -> DataFrame:
    """Name a DataFrame for ``spark.sql`` and hand it back."""
    df.createOrReplaceTempView(name)
    return df


def with_run_order(runs: DataFrame, order: Sequence[str] = tuple(SAMPLE_ORDER)) -> DataFrame:
    """Run log with text keys, the default label filled in, and the position of each size."""
    return (
        runs.withColumn("analysis", F.col("analysis").cast("string"))
        .withColumn("notes", F.coalesce("notes", F.lit(FULL_LABEL)))
        .withColumn("sample_order", position_in("notes", order))
    )


def read_run_log(spark: SparkSession, path: str | list[str], environment: str | None = None) -> DataFrame:
    runs = with_run_order(spark.read.csv(path, header=True, schema=RUN_LOG_SCHEMA))
    if environment is not None:
        runs = runs.withColumn("environment", F.lit(environment))
    return runs.orderBy("analysis", "technology", "sample_order")


def listed_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Path and length of every file below ``paths``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(paths).select("path", "length")


def input_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row with the size in MB and the number of data rows of a Parquet or CSV input.

    Parquet rows come from the footers. A CSV has one header line per file. A missing
    path counts as empty.
    """
    if not path_exists(spark, path):
        return spark.range(1).select(
            F.lit(path).alias("input_file"), F.lit(0.0).alias("input_size_mb"), F.lit(0).cast("long").alias("input_rows")
        )
    if path.rstrip("/").endswith(".csv"):
        per_file = spark.read.text(path).groupBy("_metadata.file_path").agg((F.count(F.lit(1)) - 1).alias("rows"))
        rows = per_file.agg(F.sum("rows"))
    else:
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)))
    return listed_files(spark, path).agg(
        F.lit(path).alias("input_file"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(MEGABYTE), 2).alias("input_size_mb"),
        F.coalesce(F.first(rows.scalar()), F.lit(0)).cast("long").alias("input_rows"),
    )
