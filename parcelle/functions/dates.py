"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from parcelle.functions._util import col_of


def to_date_lenient(c, dtype=None) -> Column:
    """Date from a string (``yyyy-MM-dd``, optionally followed by a time) or a
    timestamp. Blank or malformed strings give null instead of raising."""
    col = col_of(c)
    if dtype is not None and isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return F.to_date(col)
    if dtype is not None and not isinstance(dtype, StringType):
        return F.try_to_date(col.cast("string"))
    return F.try_to_date(col.cast("string"))


def month_start(c) -> Column:
    """First day of the month, as a date."""
    return F.date_trunc("month", col_of(c)).cast("date")


def timestamp_lit(value) -> Column:
    """A timestamp literal without zone (``now`` is always a parameter)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(now, days: int) -> Column:
    """``now - days``, with ``now`` a timestamp literal or column."""
    base = now if isinstance(now, Column) else timestamp_lit(now)
    return base - F.make_dt_interval(F.lit(days))
