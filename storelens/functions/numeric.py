"""Rounding, means and ratios with results that do not depend on partition order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(col: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as double."""
    return F.round(col.cast("decimal(28,8)"), digits).cast("double")


def mean_of(col: Column) -> Column:
    """Mean of a decimal or integer column: exact sum, one division."""
    return F.sum(col).cast("double") / F.count(col)


def exact_mean(col: Column) -> Column:
    """Mean of a double column, summed as decimals so that the order of rows is irrelevant."""
    return mean_of(col.cast("decimal(28,10)"))


def pct_of_rows(condition: Column, rows: Column | None = None) -> Column:
    """100 * rows satisfying the condition / all rows of the group."""
    hits = F.sum(F.when(condition, 1).otherwise(0))
    return hits.cast("double") * 100 / (F.count(F.lit(1)) if rows is None else rows)


def clip(col: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))


def finite_or_null(col: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def min_max_scale(col: Column, low: Column, high: Column) -> Column:
    """(x - min) / (max - min), guarded against a constant column."""
    return (col - low) / (high - low + F.lit(1e-9))


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double, null where the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
