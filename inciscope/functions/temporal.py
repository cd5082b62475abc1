"""Timestamp parsing and calendar attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inciscope import config

WEEKEND_DAYS = (1, 7)  # dayofweek: 1 is Sunday


def parse_timestamp(col: Column, formats: Sequence[tuple[str, str | None]] = config.TIMESTAMP_FORMATS) -> Column:
    """First format that parses wins, NULL when none does.

    A failed parse is paid for with an exception per row, so a format may carry a pattern that all its values
    match; text without it skips the attempt.
    """
    text = F.trim(col)
    attempts = []
    for pattern, marker in formats:
        attempt = F.try_to_timestamp(text, F.lit(pattern))
        attempts.append(attempt if marker is None else F.when(text.rlike(marker), attempt))
    return F.coalesce(*attempts)


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "dayofweek": F.dayofweek(ts),
    }


def date_key(ts: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than formatting and re-parsing text."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def quarter_label(ts: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(ts).cast("string"))


def weekday_type(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday")
