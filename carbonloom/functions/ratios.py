"""Divisions and differences under the three zero/NULL conventions in use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(numerator: Column, denominator: Column, dtype: str = "decimal(18,4)") -> Column:
    """0 unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0)).cast(dtype)


def divide(numerator: Column, denominator: Column, alternate=None) -> Column:
    """BLANK-aware division: zero or missing denominator gives ``alternate``, missing numerator NULL.

    Always in double precision, as report engines do.
    """
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if alternate is None:
        return quotient
    return F.when(F.coalesce(denominator, F.lit(0)) == 0, F.lit(alternate).cast("double")).otherwise(quotient)


def blank_minus(left: Column, right: Column) -> Column:
    """A missing side counts as 0; NULL only when both are missing."""
    return F.when(left.isNotNull() | right.isNotNull(), F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0)))


def growth(current: Column, prior: Column) -> Column:
    return divide(blank_minus(current, prior), prior)


def cagr(current: Column, base: Column, years: int) -> Column:
    return F.when(
        current.isNotNull() & base.isNotNull() & (base > 0),
        F.pow(current.cast("double") / base.cast("double"), F.lit(1.0 / years)) - 1,
    )


def total_row_guard(measure: Column, code: Column, total) -> Column:
    """Keep a whole-country measure on the total row only, so that sums do not multiply it."""
    return F.when(code == F.lit(total), measure)
