"""Money totals, rounded ratios and flags as built-in column expressions.

Totals are DECIMAL(20,2): wide enough for a 100 TB history, and narrow enough that
Spark keeps 18 fractional digits when two totals are divided.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(20,2)"
CENTS = "decimal(16,2)"


def total(column: str | Column) -> Column:
    return F.sum(column).cast(TOTAL)


def total_or_zero(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(TOTAL)


def whole(column: str | Column) -> Column:
    """Sum of a small integer column as BIGINT."""
    return F.sum(column).cast("bigint")


def whole_or_zero(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def _divided(numerator: Column, denominator: Column) -> Column:
    bottom = denominator.cast(TOTAL)
    return numerator.cast(TOTAL) / F.nullif(bottom, F.lit(0).cast(TOTAL))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to 2 decimals; NULL on a zero denominator."""
    return F.round(_divided(numerator, denominator), 2).cast(TOTAL)


def percent(numerator: Column, denominator: Column) -> Column:
    """0-100 percentage to 2 decimals; NULL on a zero denominator."""
    return F.round(_divided(numerator, denominator) * F.lit(100), 2).cast(TOTAL)


def fraction(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient (18 decimals), as the semantic measures use it."""
    return _divided(numerator, denominator)


def one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("smallint")


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)
