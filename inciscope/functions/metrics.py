"""Aggregate expressions shared by the views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; NULL counts as not holding."""
    return F.count_if(condition)


def ratio_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """100 * num / den as a rounded double, for a denominator that is never zero."""
    return F.round(F.lit(100.0) * num / den, digits)


def safe_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """As ``ratio_pct``, but NULL for a zero denominator."""
    return ratio_pct(num, F.nullif(den, F.lit(0)), digits)


def rate_pct(condition: Column, digits: int = 2) -> Column:
    """Share of the group's rows where the condition holds."""
    return ratio_pct(F.count_if(condition), F.count(F.lit(1)), digits)


def avg_per_period(total: Column, periods: Column | int, digits: int = 0) -> Column:
    periods = F.lit(periods) if isinstance(periods, int) else periods
    return F.round(total / periods.cast("double"), digits)


def mode_of(col: Column) -> Column:
    """Most frequent value, smallest on ties.

    Holds one counter per distinct value, so it is for coded columns; ``roll_up_modes`` counts by shuffle.
    """
    return F.mode(col, True)


def distinct_codes(col: Column) -> Column:
    """COUNT(DISTINCT) for a coded column: a set per task, where the general form would copy every row."""
    return F.size(F.collect_set(col)).cast("bigint")


def round_even(col: Column, digits: int) -> Column:
    """Round halves to even after scaling, as numeric Python arrays do."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def avg_of_rates(col: Column, digits: int = 2) -> Column:
    """Average of already rounded rates, in decimal so that halves round up exactly."""
    return F.round(F.avg(col.cast("decimal(18,2)")), digits).cast("double")
