"""Dates and refresh periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
EPOCH = dt.date(1970, 1, 1)

# Named periods in days (fixed values).
PERIOD_DAYS = {"day": 1, "week": 7, "month": 30}


def parse_date(c: Column) -> Column:
    """``YYYY-MM-DD`` text (one-digit month or day allowed) to a date; anything else is NULL."""
    return F.when(c.rlike(DATE_PATTERN), F.try_to_date(c, "yyyy-M-d"))


def is_date_text(c: Column) -> Column:
    return parse_date(c).isNotNull()


def date_or_epoch(d: Column) -> Column:
    return F.coalesce(d, F.lit(EPOCH))


def format_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def days_before(d: Column, days: int) -> Column:
    return F.date_sub(d, days)


def year_of(d: Column) -> Column:
    return F.year(d)


def period_days(period: str | int | None) -> int:
    """Length of a refresh period. Whole numbers win over names; empty means no look-back."""
    if period is None or period == "":
        return 0
    try:
        return int(period)
    except ValueError:
        pass
    if period not in PERIOD_DAYS:
        raise ValueError(f"unknown period {period!r}: use {sorted(PERIOD_DAYS)} or a day count")
    return PERIOD_DAYS[period]


def period_start(watermark: dt.date, period: str | int | None) -> dt.date:
    return watermark - dt.timedelta(days=period_days(period))


def literal_for(df: DataFrame, column: str, value: dt.date | dt.datetime) -> Column:
    """The value as a literal a scan can compare with the column: a wall-clock column must not
    meet an instant, or Spark converts the column and the filter stays above the scan."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    return F.lit(value)
