"""Variance, percentage and materiality as Column expressions.

Money is decimal from end to end. Totals are ``decimal(38,2)``: the sum of a
``decimal(18,2)`` column over one very large account does not fit 18 digits.
Only percentages are double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(38,2)"
DEFAULT_THRESHOLD = 0.5

BREAK = "BREAK"
PASS = "PASS"


def total(col: Column) -> Column:
    """Money at the type and scale of account totals."""
    return col.cast(TOTAL)


def total_or_zero(col: Column) -> Column:
    return total(F.coalesce(total(col), F.lit(0)))


def variance(other: Column, base: Column) -> Column:
    """Signed difference of two balances; an absent side counts as zero."""
    return total(total_or_zero(other) - total_or_zero(base))


def variance_pct(diff: Column, base: Column) -> Column:
    """Variance in percent of the base, 4 places; NULL on a zero base."""
    base = F.nullif(base.cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * diff.cast("double") / base, 4)


def presence(balance: Column) -> Column:
    """1 where a side of the tie-out is absent, 0 where it has a balance."""
    return balance.isNull().cast("int")


def exceeds(diff: Column, base: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """True where the variance is strictly more than ``threshold`` percent of the base.

    Both sides are multiplied out, so the test is exact, divides by nothing and
    also holds on a zero base, where any variance at all exceeds the threshold.
    """
    limit = Decimal(str(threshold))
    if limit < 0 or -limit.as_tuple().exponent > 4:
        raise ValueError(f"threshold must be >= 0 with at most 4 decimals, got {threshold}")
    return F.lit(100) * F.abs(diff) > F.lit(limit) * F.abs(base)


def status_detail(diff: Column, base: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """BREAK or PASS of the detail tie-out."""
    return F.when(exceeds(diff, base, threshold), BREAK).otherwise(PASS)


def status_filed(
    diff: Column,
    base: Column,
    missing_base: Column,
    missing_other: Column,
    threshold: float = DEFAULT_THRESHOLD,
) -> Column:
    """BREAK or PASS of the filed tie-out; a one-sided account breaks at any amount."""
    one_sided = (missing_base + missing_other) > 0
    return F.when(one_sided | exceeds(diff, base, threshold), BREAK).otherwise(PASS)
