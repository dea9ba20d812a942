"""Column expressions shared by the operators. All are built-ins, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from runwaylens.schema import DATE_FORMATS, MISSING_TOKENS, MONTH_LABELS, WHITESPACE


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column, tokens: Sequence[str] = tuple(MISSING_TOKENS)) -> Column:
    """NULL where a text cell holds one of the missing-value tokens."""
    c = as_column(c)
    return F.when(~c.isin(*tokens), c)


def present(*columns: str) -> Column:
    """All columns are not NULL; unlike ``na.drop`` the conditions reach the file scan."""
    first, *rest = [F.col(c).isNotNull() for c in columns]
    for condition in rest:
        first = first & condition
    return first


def nan_to_null(c: str | Column) -> Column:
    """NULL for NaN, which would poison sums and averages; evaluates ``c`` once."""
    return F.nanvl(as_column(c), F.lit(None).cast("double"))


def to_number(c: str | Column) -> Column:
    """DOUBLE, with NULL for text that is no number and for NaN."""
    return nan_to_null(as_column(c).try_cast("double"))


def to_date_text(c: str | Column, formats: Sequence[str] = tuple(DATE_FORMATS)) -> Column:
    """The date as ``yyyy-MM-dd`` text, NULL where none of the forms fits.

    A year, month and day (and a time behind it, which is cut off) are read by a cast; the other
    forms are tried in order on what is left.
    """
    c = strip_text(c)
    plain = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), c).try_cast("date")
    others = [F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(plain, *others).cast("string")


def to_flag(c: str | Column) -> Column:
    """INT flag; missing and unreadable cells count as 0."""
    return F.coalesce(to_number(c).try_cast("int"), F.lit(0))


def strip_text(c: str | Column) -> Column:
    """Remove all leading and trailing whitespace (plain ``trim`` removes spaces only)."""
    return F.trim(as_column(c), F.lit(WHITESPACE))


def strip_upper(c: str | Column) -> Column:
    return F.upper(strip_text(c))


def in_range_or_null(c: str | Column, lo: float, hi: float) -> Column:
    return F.coalesce(as_column(c).between(lo, hi), F.lit(True))


def out_of_range(c: str | Column, lo: float, hi: float) -> Column:
    c = as_column(c)
    return (c < lo) | (c > hi)


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; NULL stays NULL (``greatest`` and ``least`` alone would skip it)."""
    c = as_column(c)
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def delay_band(c: str | Column, short: float = 15, long: float = 60) -> Column:
    """low below ``short``, medium up to and including ``long``, high above; NULL stays NULL."""
    c = as_column(c)
    return (
        F.when(c < short, F.lit("low"))
        .when(c <= long, F.lit("medium"))
        .when(c > long, F.lit("high"))
    )


def flag_rate(c: str | Column, digits: int = 4) -> Column:
    """Aggregate: share of set flags among all rows of the group."""
    return F.round(F.sum(as_column(c).cast("double")) / F.count(F.lit(1)), digits)


def mean_from(total: str | Column, n: str | Column) -> Column:
    """Average from a sum and a count; NULL where nothing was counted."""
    return F.try_divide(as_column(total), as_column(n))


def lookup(c: str | Column, labels: Mapping[str, str], default: str | Column | None = None) -> Column:
    """Label of a code; unknown codes give NULL or ``default``."""
    c = as_column(c)
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    found = F.create_map(*pairs)[c]
    return found if default is None else F.coalesce(found, as_column(default))


def position_in(c: str | Column, order: Sequence[str], missing: int | None = None) -> Column:
    """Zero-based position in a fixed list, for sorting in a custom order."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), as_column(c))
    found = F.when(pos > 0, (pos - 1).cast("int"))
    return found if missing is None else F.coalesce(found, F.lit(missing))


def month_label(c: str | Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTH_LABELS]), as_column(c) - 1)


def speedup_tier(ratio: str | Column) -> Column:
    """Class of a speed ratio: missing, much_faster (>= 2), faster (>= 1) or slower."""
    r = as_column(ratio)
    return (
        F.when(r.isNull(), F.lit("missing"))
        .when(r >= 2, F.lit("much_faster"))
        .when(r >= 1, F.lit("faster"))
        .otherwise(F.lit("slower"))
    )


def slowdown(ratio: str | Column, digits: int = 1) -> Column:
    """How many times slower, where the ratio is below one."""
    r = as_column(ratio)
    return F.when(r < 1, F.round(F.try_divide(F.lit(1.0), r), digits))
