"""Cleaning of raw fact rows, and counts of what each rule removes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from runwaylens.functions import in_range_or_null, out_of_range, present, strip_text, strip_upper, to_date_text, to_flag, to_number
from runwaylens.schema import (
    CODE_COLUMNS,
    DATE_FORMATS,
    DELAY_RANGE,
    FACT_COLUMNS,
    MANDATORY_COLUMNS,
    NUMBER_COLUMNS,
    RANGE_COLUMNS,
)
from runwaylens.sources.readers import normalise_missing


def select_present(df: DataFrame, columns: Sequence[str] = tuple(FACT_COLUMNS)) -> DataFrame:
    return df.select([c for c in columns if c in df.columns])


def drop_missing_keys(df: DataFrame, keys: Sequence[str] = tuple(MANDATORY_COLUMNS)) -> DataFrame:
    return df.where(present(*keys))


def drop_blank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose keys hold something other than white space."""
    for k in keys:
        df = df.where(F.length(strip_text(k)) > 0)
    return df


def typed(df: DataFrame, date_formats: Sequence[str] = tuple(DATE_FORMATS)) -> DataFrame:
    """Text cells to their types, bad cells to NULL; keys are not yet trimmed."""
    rules = {c: to_number(c) for c in NUMBER_COLUMNS}
    rules |= {c: F.col(c).try_cast("int") for c in ("year", "month")}
    rules |= {"fl_date": to_date_text("fl_date", date_formats), "cancelled": to_flag("cancelled")}
    return df.select(*[rules[c].alias(c) if c in rules else F.col(c) for c in df.columns])


def keep_delay_range(df: DataFrame, columns: Sequence[str] = tuple(RANGE_COLUMNS)) -> DataFrame:
    for c in columns:
        if c in df.columns:
            df = df.where(in_range_or_null(c, *DELAY_RANGE))
    return df


def outliers(df: DataFrame, column: str) -> DataFrame:
    return df.where(out_of_range(column, *DELAY_RANGE))


def normalise_codes(df: DataFrame, columns: Sequence[str] = tuple(CODE_COLUMNS)) -> DataFrame:
    return df.select(*[strip_upper(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def typed_facts(raw: DataFrame, date_formats: Sequence[str] = tuple(DATE_FORMATS)) -> DataFrame:
    """Known columns, typed, without missing-value tokens.

    Only codes need the token list: no token is a number or a date.
    """
    present = select_present(raw)
    codes = [c for c in CODE_COLUMNS if c in present.columns]
    return typed(normalise_missing(present, codes), date_formats)


def evaluated_once(df: DataFrame) -> DataFrame:
    """Same rows, with every column computed before anything downstream uses it.

    The optimizer moves filters below projections by repeating the projected expression in
    the filter, so parsing would run once per use. It does not move them below a generator,
    here one that yields the row itself. Only for plans that need all columns, since it also
    stops column pruning.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def clean_facts(raw: DataFrame, date_formats: Sequence[str] = tuple(DATE_FORMATS)) -> DataFrame:
    """Cleaned fact rows of a raw text table.

    The order of the steps matters: keys are checked before trimming, so a key of
    blanks survives as an empty text; copies are removed after normalising. The
    whole chain is narrow up to the final distinct, which drops copies inside each
    task before it shuffles, so even a row repeated in a third of the table is
    sent only once per task.
    """
    kept = keep_delay_range(drop_missing_keys(evaluated_once(typed_facts(raw, date_formats))))
    return normalise_codes(kept).distinct()


def _outcome(columns: Sequence[str]) -> Column:
    """Name of the first rule that removes a typed row, NULL for a row that stays."""
    missing = F.lit(False)
    for k in MANDATORY_COLUMNS:
        missing = missing | F.col(k).isNull()
    rule = F.when(missing, F.lit("missing_key"))
    for c in RANGE_COLUMNS:
        if c in columns:
            rule = rule.when(out_of_range(c, *DELAY_RANGE), F.lit(f"{c}_out_of_range"))
    return rule


def _groups(raw: DataFrame, date_formats: Sequence[str]) -> DataFrame:
    """Distinct cleaned rows with their number of copies, and one row per rule (``outcome``) for all that it removed.

    One scan and one shuffle. Removed rows carry only the name of their rule, so they melt into one group per rule and
    task.
    """
    rows = evaluated_once(typed_facts(raw, date_formats))
    columns = rows.columns
    tagged = rows.withColumn("outcome", _outcome(columns))
    stays = F.col("outcome").isNull()
    norm = normalise_codes(tagged).select("outcome", *[F.when(stays, F.col(c)).alias(c) for c in columns])
    return norm.groupBy("outcome", *columns).agg(F.count(F.lit(1)).alias("copies"))


def _metrics(columns: Sequence[str]) -> list[tuple[str, Column]]:
    """Aggregates over ``_groups``: rows before and after, rows removed per rule, NULLs per column left."""
    stays = F.col("outcome").isNull()
    rules = ["missing_key"] + [f"{c}_out_of_range" for c in RANGE_COLUMNS if c in columns]
    kept_rows = F.count_if(stays)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    metrics = [("rows_in", F.coalesce(F.sum("copies"), F.lit(0)))]
    metrics += [(f"removed_{r}", total(F.col("outcome") == r)) for r in rules]
    metrics += [("removed_duplicates", total(stays) - kept_rows), ("rows_out", kept_rows)]
    metrics += [("columns_out", F.lit(len(columns)).cast("long"))]
    metrics += [(f"nulls_{c}", F.count_if(stays & F.col(c).isNull())) for c in columns]
    return [(name, m.cast("long")) for name, m in metrics]


def cleaning_report(raw: DataFrame, date_formats: Sequence[str] = tuple(DATE_FORMATS)) -> DataFrame:
    """(metric, value) rows: what ``clean_facts`` with the same date forms keeps and removes, without writing it."""
    groups = _groups(raw, date_formats)
    metrics = _metrics(groups.columns[1:-1])
    return groups.agg(*[m.alias(name) for name, m in metrics]).unpivot([], [name for name, _ in metrics], "metric", "value")


def write_cleaned(
    raw: DataFrame, write: Callable[[DataFrame], None], date_formats: Sequence[str] = tuple(DATE_FORMATS)
) -> DataFrame:
    """Write the rows of ``clean_facts`` with ``write`` and return the report on them, in one pass over ``raw``.

    The figures are observed where the cleaned rows are written, behind the only shuffle: tasks of the last stage
    count once, however often a lost executor makes earlier ones run again. ``write`` must run exactly one job over
    the rows that it is given.
    """
    groups = _groups(raw, date_formats)
    columns = groups.columns[1:-1]
    metrics = _metrics(columns)
    seen = Observation("cleaned")
    watched = groups.observe(seen, *[m.alias(name) for name, m in metrics])
    write(watched.where(F.col("outcome").isNull()).select(*columns))
    figures = [(name, int(seen.get.get(name) or 0)) for name, _ in metrics]
    return raw.sparkSession.createDataFrame(figures, "metric string, value long")
