"""Date and time functions (DAT-1..6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmart.functions.columns import as_col

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def parse_timestamp(col: str | Column, lenient: bool = False) -> Column:
    """DAT-1: ISO-8601 text -> timestamp. Malformed text raises (ANSI) unless lenient."""
    c = as_col(col)
    return F.try_to_timestamp(c) if lenient else F.to_timestamp(c)


def utc_date(ts: str | Column) -> Column:
    """DAT-5: calendar date of the instant in UTC, independent of the session zone."""
    days = F.floor(F.unix_seconds(as_col(ts)) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)


def year(d: str | Column) -> Column:
    """DAT-2 (on a date)."""
    return F.year(as_col(d)).cast("int")


def month(d: str | Column) -> Column:
    """DAT-3."""
    return F.month(as_col(d)).cast("int")


def day(d: str | Column) -> Column:
    """DAT-4."""
    return F.dayofmonth(as_col(d)).cast("int")


def iso_format(ts: str | Column) -> Column:
    """DAT-6: ``%Y-%m-%dT%H:%M:%S``."""
    return F.date_format(as_col(ts), ISO_SECONDS)

