"""Column types of raw text tables, from one pass over all cells.

Every cell has a kind: flag, int, double, date or text; a missing cell has none. Kinds form a lattice (int below
double, everything below text), so counts of kinds from any parts of a table add up to the counts of the whole, and
the type of a column is the least one that holds its cells. Up to a small share of cells may not fit: these are
counted and shown, and become NULL, where one bad cell among millions would else turn its column into text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.functions import missing_to_null, strip_text
from runwaylens.sources.readers import read_raw_csv

# Kinds of cells, and for each type, least first, the kinds that it holds and its storage type.
KINDS = ["flag", "int", "double", "date", "text"]
TYPES = {
    "flag": (["flag"], "boolean"),
    "int": (["int"], "bigint"),
    "double": (["int", "double"], "double"),
    "date": (["date"], "date"),
    "text": (KINDS, "string"),
}
# Cells of another kind that a column may have before its type gives way, as a share of its cells.
TOLERANCE = 0.01


def stripped(cell: Column) -> Column:
    """A cell without white space around it; most cells hold none at all, which a match tells faster than a search."""
    return F.when(cell.rlike("^[!-~]+$"), cell).otherwise(strip_text(cell))


def is_whole(text: Column) -> Column:
    return text.rlike(r"^[+-]?\d+$")


def is_number(text: Column) -> Column:
    return text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") | F.lower(text).rlike(r"^[+-]?inf(inity)?$")


def is_day(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")


def cell_kind(cell: Column) -> Column:
    """Kind of a text cell; NULL for a missing one. White space around a value does not count."""
    text = missing_to_null(stripped(cell))
    whole = is_whole(text) & text.try_cast("bigint").isNotNull()
    number = is_number(text)
    day = is_day(text) & text.try_cast("date").isNotNull()
    return (
        F.when(text.isNull(), None)
        .when(F.lower(text).isin("true", "false"), "flag")
        .when(whole, "int")
        .when(number, "double")
        .when(day, "date")
        .otherwise("text")
    )


def kind_counts(raw: DataFrame) -> DataFrame:
    """One row for each column: cells of every kind, missing cells, and the smallest text of every kind.

    One scan, however many columns there are. Equal cells of a column are counted in each task first, and a kind is
    worked out once for each different cell.
    """
    columns = raw.columns
    cells = [F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("string").alias("cell")) for i, c in enumerate(columns)]
    long = raw.select(F.inline(F.array(*cells))) if columns else raw.sparkSession.createDataFrame([], "at int, cell string")
    different = long.groupBy("at", "cell").agg(F.count("*").alias("c"))
    kinds = different.groupBy("at", cell_kind(F.col("cell")).alias("kind")).agg(F.sum("c").alias("c"), F.min("cell").alias("least"))
    counts = [F.sum(F.when(F.col("kind") == k, F.col("c"))).alias(k) for k in KINDS]
    samples = [F.min(F.when(F.col("kind") == k, F.col("least"))).alias(f"least_{k}") for k in KINDS]
    missing = F.sum(F.when(F.col("kind").isNull(), F.col("c"))).alias("missing")
    found = kinds.groupBy("at").agg(*counts, missing, *samples)
    names = raw.sparkSession.createDataFrame(list(enumerate(columns)), "at int, column string")
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in [*KINDS, "missing"]]
    return names.join(found, "at", "left").select("at", "column", *filled, *[f"least_{k}" for k in KINDS])


def inferred_types(counts: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(position, column, type, cells, missing, bad_cells, bad_example) from counts of kinds.

    The type is the least one that holds all but a share of ``tolerance`` of the cells, text where no other does. A
    column without cells is text. ``bad_example`` is one of the cells that do not fit.
    """
    total = sum((F.col(k) for k in KINDS[1:]), F.col(KINDS[0]))

    def misfits(name: str) -> Column:
        return total - sum((F.col(k) for k in TYPES[name][0]), F.lit(0))

    least = F.when(total == 0, "text")
    for name in TYPES:
        least = least.when(misfits(name) <= total * tolerance, name)
    chosen = counts.withColumn("type", least)
    bad, example = F.lit(0), F.lit(None).cast("string")
    for name, (held, _) in TYPES.items():
        others = [F.col(f"least_{k}") for k in reversed(KINDS) if k not in held]
        bad = F.when(F.col("type") == name, misfits(name)).otherwise(bad)
        example = F.when(F.col("type") == name, F.coalesce(*others, F.lit(None).cast("string"))).otherwise(example)
    return chosen.select(
        F.col("at").alias("position"), "column", "type", total.alias("cells"), "missing", bad.cast("long").alias("bad_cells"), example.alias("bad_example")
    )


@dataclass(frozen=True)
class Inferred:
    """``rows`` with the inferred types, and the ``report`` on every column."""

    rows: DataFrame
    report: DataFrame


def typed_cell(cell: Column, type_name: str) -> Column:
    """A text cell in its column's type; NULL where it does not fit."""
    if type_name == "text":
        return missing_to_null(cell)
    # The kinds that a type holds, by one test each; no missing token passes any of them.
    text = stripped(cell)
    fits = {"flag": F.lower(text).isin("true", "false"), "int": is_whole(text), "double": is_number(text), "date": is_day(text)}
    return F.when(fits[type_name], text).try_cast(TYPES[type_name][1])


def with_inferred_types(raw: DataFrame, tolerance: float = TOLERANCE) -> Inferred:
    """Text columns cast to the types of their cells; other columns stay. Missing tokens are NULL and decide nothing."""
    text = [f.name for f in raw.schema if isinstance(f.dataType, T.StringType)]
    report = inferred_types(kind_counts(raw.select(*[F.col(f"`{c}`") for c in text])), tolerance)
    # One row for each column of the table.
    found = report.collect()
    types = {r.column: r.type for r in found}
    cells = [typed_cell(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns]
    kept = raw.sparkSession.createDataFrame(found, report.schema)
    return Inferred(raw.select(*cells), kept)


def read_inferred_csv(spark: SparkSession, path: str | list[str], tolerance: float = TOLERANCE) -> Inferred:
    """Headered CSV with types inferred from all of its cells."""
    return with_inferred_types(read_raw_csv(spark, path), tolerance)
