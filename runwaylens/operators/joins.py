"""Joins: NULL keys that match, and sides that share one aggregate. Which side is broadcast is left to the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition under which NULL keys match each other."""
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def shared(aggregate: DataFrame) -> DataFrame:
    """An aggregate from which several branches of one plan are made, so that it is computed once.

    Branches that use different columns would each get an aggregate of their own, pruned to these. A generator that
    yields the whole row keeps all columns below it, which leaves the branches with equal plans up to there: the
    shuffle of the first is then read by the others again. Only for aggregated rows, which are few.
    """
    return aggregate.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in aggregate.columns]))))
