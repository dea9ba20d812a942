"""Folders of CSV files to one Parquet table, file by file accounted for.

Every file has an id made from its path, so neither long paths nor files of one name in several folders matter. All
files are converted by one job. Where that job fails, one pass over the bytes finds the files that cannot be read to
their end; they are reported with their reason, and the job runs again without them.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.schema import FACT_SCHEMA
from runwaylens.sources.readers import CORRUPT, path_exists, without_nan
from runwaylens.sources.writers import write_parquet

ID_DIGITS = 15
# A byte order mark is no part of the first line, and the last line may lack its end.
UNCOUNTED_BYTES = 3


def source_path() -> Column:
    """Full path of the file that a row comes from, as people write it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):///", "$1:/")


def plain_path(uri: str) -> str:
    """An encoded location as ``source_path`` writes it: decoded, without the empty host that listings put in."""
    return re.sub(r"^(\w+):///", r"\1:/", unquote(uri))


def file_id(path: Column) -> Column:
    """A letter and hex digits that stand for a path, the same in every run and never taken for a number."""
    return F.concat(F.lit("f"), F.substring(F.sha2(path, 256), 1, ID_DIGITS))


def existing(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    return [f for f in folders if path_exists(spark, f)]


def file_manifest(spark: SparkSession, folders: Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """(file_id, source_file, length) of every matching file in the folders that exist, empty files included."""
    found = existing(spark, folders)
    if not found:
        return spark.createDataFrame([], "file_id string, source_file string, length long")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(found)
    # The scan passes over files without a byte; the listing does not.
    names = spark.createDataFrame([(plain_path(n),) for n in listed.inputFiles()], "source_file string").distinct()
    lengths = listed.select(source_path().alias("source_file"), "length")
    return names.join(lengths, "source_file", "left").select(
        file_id(F.col("source_file")).alias("file_id"), "source_file", F.coalesce("length", F.lit(0)).alias("length")
    )


def _without(df: DataFrame, skipped: Collection[str]) -> DataFrame:
    """Leave out files; the condition is on the path alone, so they are not opened."""
    return df.where(~F.col("_metadata.file_path").isin(*skipped)) if skipped else df


def read_csv_folders(
    spark: SparkSession,
    folders: Sequence[str],
    schema: T.StructType = FACT_SCHEMA,
    pattern: str = "*.csv",
    skipped: Collection[str] = (),
) -> DataFrame:
    """Every matching CSV file in the folders that exist, with path and id of its file and any unparseable line."""
    found = existing(spark, folders)
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not found:
        more = [T.StructField(c, T.StringType()) for c in ("source_file", "file_id")]
        return spark.createDataFrame([], T.StructType([*fields, *more]))
    reader = spark.read.schema(fields).option("header", True).option("pathGlobFilter", pattern)
    rows = _without(reader.option("columnNameOfCorruptRecord", CORRUPT).csv(found), skipped)
    return without_nan(rows.select("*", source_path().alias("source_file"), file_id(source_path()).alias("file_id")))


def unreadable_files(
    spark: SparkSession, folders: Sequence[str], pattern: str = "*.csv", known: Collection[str] = ()
) -> dict[str, str]:
    """Files (by encoded path) that cannot be read to their end, each with the reason.

    One pass over all lines that gives up on a file instead of failing; a file whose lines hold fewer bytes than the
    file was given up. Only such files are then read once more, each by itself, for the reason.
    """
    found = existing(spark, folders)

    def lines(**options) -> DataFrame:
        reader = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").options(**options)
        return reader.text(found)

    held = _without(lines(ignoreCorruptFiles=True, ignoreMissingFiles=True), known)
    counted = held.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    files = _without(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(found), known)
    sizes = files.select(F.col("_metadata.file_path").alias("path"), "length")
    short = sizes.join(counted, "path", "left").where(F.coalesce("bytes", F.lit(0)) < F.col("length") - UNCOUNTED_BYTES)
    reasons = {}
    for row in short.select("path").collect():
        try:
            lines().where(F.col("_metadata.file_path") == row.path).write.format("noop").mode("overwrite").save()
        except (Py4JJavaError, PySparkException) as e:
            reasons[row.path] = reason(e)
    return reasons


def reason(error: Exception) -> str:
    """The innermost cause of a failed job, in one line."""
    if isinstance(error, Py4JJavaError):
        cause = error.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        text = cause.toString()
    else:
        text = str(error)
        causes = [line for line in text.splitlines() if line.startswith("Caused by: ")]
        text = causes[-1].removeprefix("Caused by: ") if causes else text
    return " ".join(text.splitlines()[0].split())


def convert_csv_folders(
    spark: SparkSession, folders: Sequence[str], out: str, schema: T.StructType = FACT_SCHEMA, pattern: str = "*.csv"
) -> DataFrame:
    """Convert all CSV files to one Parquet folder split by ``file_id``; return one status row for each file.

    Status: `converted`, `header_only` (no rows), `empty` (no bytes) or `failed` with a ``reason``; a failed file gives
    no rows at all, and the others are converted. ``bad_rows`` counts lines that do not fit the schema (kept, with
    their text). Each task writes what it reads, so a very large file is spread over its input splits. An error that no
    file explains is raised.
    """
    failed: dict[str, str] = {}
    while True:
        rows = read_csv_folders(spark, folders, schema, pattern, failed)
        try:
            write_parquet(rows, out, partition_by=["file_id"])
            break
        except (Py4JJavaError, PySparkException):
            more = unreadable_files(spark, folders, pattern, failed)
            if not more:
                raise
            failed |= more
    return conversion_status(file_manifest(spark, folders, pattern), converted(spark, out, rows.schema), failed)


def converted(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(out)


def conversion_status(manifest: DataFrame, rows: DataFrame, failed: dict[str, str]) -> DataFrame:
    """Rows, bad lines, status and reason for each file of a manifest."""
    counts = rows.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("bad_rows"))
    spark = manifest.sparkSession
    reasons = spark.createDataFrame([(plain_path(p), r) for p, r in failed.items()], "source_file string, reason string")
    met = manifest.join(counts, "file_id", "left").join(reasons, "source_file", "left")
    status = (
        F.when(F.col("reason").isNotNull(), "failed")
        .when(F.col("rows").isNotNull(), "converted")
        .when(F.col("length") == 0, "empty")
        .otherwise("header_only")
    )
    return met.select(
        "file_id",
        "source_file",
        "length",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"),
        status.alias("status"),
        "reason",
    )
