"""Rounding, rates and averages with one set of rules for every report.

All percentages and money averages are computed on decimals: the quotient is
held to six decimal places, then rounded half away from zero.  A zero or NULL
denominator gives NULL instead of an ANSI division error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTIENT = "decimal(38,6)"
WIDE_MONEY = "decimal(38,2)"


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero after fixing the value to six decimals."""
    return F.round(value.cast(QUOTIENT), places)


def quotient(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient of values with up to six decimals, NULL for a zero denominator."""
    den = denominator.cast(QUOTIENT)
    return (numerator.cast(QUOTIENT) / F.nullif(den, F.lit(0).cast(QUOTIENT))).cast(QUOTIENT)


def percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """``numerator`` as a rounded percentage of ``denominator``."""
    return F.round(quotient(numerator * F.lit(100), denominator), places)


def percent_left(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """The rounded rest to 100 of the *unrounded* percentage."""
    return F.round(F.lit(100) - quotient(numerator * F.lit(100), denominator), places)


def money_total(value: Column) -> Column:
    """Exact decimal sum, rounded to cents."""
    return F.round(F.sum(value).cast(WIDE_MONEY), 2)


def whole_average(value: Column) -> Column:
    """Average of integers that keeps only the whole part (truncating)."""
    rows = F.nullif(F.count(value), F.lit(0).cast("bigint"))
    return F.call_function("div", F.sum(value), rows)


def count_where(condition: Column) -> Column:
    """Rows meeting a condition; 0 on empty input."""
    return F.count_if(condition)


def sum_where(condition: Column) -> Column:
    """Rows meeting a condition; NULL on empty input, like a SUM of a CASE."""
    return F.sum(F.when(condition, 1).otherwise(0))
