"""Rounding rules and order-independent statistics as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x: ColumnLike, digits: int) -> Column:
    """Round half away from zero on the scaled double, as SQL ROUND does.

    Spark's own ``round`` goes through the shortest decimal form of the double
    and so differs at binary ties (1.005 -> 1.01 there, 1.0 here).  Values too
    large to have that many decimals are returned as they are.
    """
    x = as_col(x)
    scale = float(10**digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + 0.0
    return F.when(F.abs(x) < 2.0**52 / scale, rounded).otherwise(x)


def round_half_even(x: ColumnLike, digits: int) -> Column:
    """Round half to even on the scaled double, as dataframe libraries do."""
    scale = float(10**digits)
    return F.rint(as_col(x) * scale) / scale


def change_pct(now: ColumnLike, before: ColumnLike) -> Column:
    """Percent change; NULL where the earlier value is zero or missing."""
    return (F.try_divide(as_col(now), as_col(before)) - 1.0) * 100.0


def spread_pct(high: ColumnLike, low: ColumnLike) -> Column:
    """High-low range in percent of the low; NULL where the low is zero."""
    return F.try_divide(as_col(high) - as_col(low), as_col(low)) * 100.0


def mean_4dp(x: ColumnLike) -> Column:
    """Mean of a column whose values carry four decimals (all stored scores do).

    Summing the scaled integers makes the result independent of the order in
    which partial aggregates merge, so a retried task cannot move the last bit
    and flip a later rounding.
    """
    units = F.rint(as_col(x) * 1e4).try_cast("bigint")
    return F.try_divide(F.sum(units) / 1e4, F.count(units))


def weighted_mean(value: ColumnLike, weight: ColumnLike) -> Column:
    """Weighted mean, NULL when all weights are zero."""
    value, weight = as_col(value), as_col(weight)
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def engagement_weight(upvotes: ColumnLike) -> Column:
    """ln(upvotes + 1)."""
    return F.ln(as_col(upvotes) + F.lit(1.0))


def pearson(x: ColumnLike, y: ColumnLike) -> Column:
    """Pearson correlation over pairs where both sides are present.

    NULL for a constant series or fewer than two pairs; the built-in ``corr``
    raises a division error there under ANSI mode.
    """
    x, y = as_col(x), as_col(y)
    spread_x = F.stddev_pop(F.when(y.isNotNull(), x))
    spread_y = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread_x * spread_y)


def softmax(*logits: Column) -> list[Column]:
    """Numerically shifted softmax over a few columns of one row."""
    top = F.greatest(*logits)
    parts = [F.exp(z - top) for z in logits]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]
