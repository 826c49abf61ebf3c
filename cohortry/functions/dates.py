"""Calendar expressions.  Inputs are cast to DATE first, so day counts are
date boundaries crossed and never depend on a time of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def us_week(day: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday.

    Spark's ``weekofyear`` is the ISO week and differs around New Year.
    """
    day = day.cast("date")
    first_weekday = F.dayofweek(F.trunc(day, "year"))
    return F.floor((F.dayofyear(day) + first_weekday - 2) / 7).cast("int") + 1


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
