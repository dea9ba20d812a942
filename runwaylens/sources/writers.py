"""Sinks: Parquet, delimited text, plain lines, tables, previews and result samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.functions import as_column
from runwaylens.sources.readers import path_exists

# Result columns of the three reports, and first cells that mark a header line.
REPORT_COLUMNS = {
    "analysis_1": ["carrier", "origin", "month", "num_flights", "min_arr_delay", "max_arr_delay",
                   "avg_arr_delay", "cancel_rate", "months_active"],
    "analysis_2": ["origin", "month", "delay_band", "num_flights", "avg_dep", "avg_arr",
                   "top_cause_1", "top_cause_2", "top_cause_3"],
    "analysis_3": ["origin", "carrier", "num_flights", "avg_dep_delay", "avg_arr_delay", "cancel_rate",
                   "avg_dep_airport", "dep_diff", "rank"],
}
HEADER_CELLS = ["op_unique_carrier", "carrier", "origin", "band", "delay_band", "cause", "rank", "rank_pos"]
SAMPLE_ROWS = 10


def _laid_out(df: DataFrame, single_file: bool) -> DataFrame:
    # One file means one task for the final write, so it is only for small results.
    return df.coalesce(1) if single_file else df


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), single_file: bool = False, rows_per_file: int = 0
) -> None:
    writer = _laid_out(df, single_file).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*partition_by).parquet(path) if partition_by else writer.parquet(path)


def arrays_as_text(df: DataFrame, sep: str = ",") -> DataFrame:
    arrays = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.select(
        *[F.array_join(F.col(c).cast("array<string>"), sep).alias(c) if c in arrays else F.col(c) for c in df.columns]
    )


def write_delimited(
    df: DataFrame, path: str, sep: str = "|", single_file: bool = False, null_value: str | None = None
) -> None:
    """Headered delimited text; arrays are joined with commas, NULL is an empty cell by default."""
    writer = _laid_out(arrays_as_text(df), single_file).write.mode("overwrite")
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.option("header", True).option("sep", sep).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    write_delimited(df, path, sep=",")


def text_lines(df: DataFrame, sep: str = "|") -> DataFrame:
    """One line per row; NULL becomes an empty field instead of being skipped."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(sep, *cells).alias("value"))


def write_text(df: DataFrame, path: str, sep: str = "|") -> None:
    text_lines(df, sep).write.mode("overwrite").text(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace table ``name`` by the result of ``df`` and return the table."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, keys: Sequence[str | Column], n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows in key order; planned as a top-n, without a full sort."""
    return df.orderBy(*keys).limit(n)


def result_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a written result as text columns, whatever headers or tab separators it has.

    Header lines are those with a header word in the first cell that stand before every other line of their file; the
    same word in the first cell of a later line is data.
    """
    line = F.translate(F.regexp_replace("value", r"^\s+|\s+$", ""), "\t", "|")
    first_cell = F.trim(F.element_at(F.split("line", r"\|"), 1))
    lines = (
        spark.read.text(path)
        .select(
            line.alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            # Lines of a block are numbered in their order.
            F.monotonically_increasing_id().alias("number"),
        )
        .where(F.length("line") > 0)
        .withColumn("is_header", first_cell.isin(*HEADER_CELLS))
    )
    # One row for each file: its first line that is no header. Files of headers only have none.
    start = lines.where(~F.col("is_header")).groupBy("file").agg(F.min(F.struct("block", "number")).alias("start"))
    kept = lines.join(start, "file").where(~F.col("is_header") | (F.struct("block", "number") > F.col("start")))
    cells = F.split("line", r"\|")
    return kept.select(cells.alias("cells")).select(*[F.get("cells", i).alias(c) for i, c in enumerate(columns)])


def sample_results(
    spark: SparkSession,
    results: Mapping[str, tuple[str, Sequence[str], Sequence[str | Column]]],
    out: str,
    n: int = SAMPLE_ROWS,
) -> DataFrame:
    """Write the first rows of every named result (path, columns, sort keys); report found or missing."""
    status = []
    for name, (path, columns, keys) in results.items():
        found = path_exists(spark, path)
        if found:
            write_delimited(preview(result_rows(spark, path, columns), keys, n), f"{out}/{name}", single_file=True)
        status.append((name, "found" if found else "missing"))
    return spark.createDataFrame(status, "result string, status string")


def numeric_key(c: str | Column) -> Column:
    """Sort key for numbers that were read back as text."""
    return as_column(c).try_cast("double")
