"""Date helpers: Julian day numbers and the calendar rules of the marts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Julian day number of 1970-01-01 (fixed value).
JD_EPOCH = 2440588


def to_jd(c) -> Column:
    """Julian day number of a date/timestamp column (noon-based day as integer)."""
    return (F.datediff(F.to_date(c), F.lit("1970-01-01")) + JD_EPOCH).cast("int")


def from_jd(c) -> Column:
    """Date for an integer Julian day number."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (c - JD_EPOCH).cast("int"))


def jd_of(d: _dt.date) -> int:
    return (d - _dt.date(1970, 1, 1)).days + JD_EPOCH


def monday_before(c) -> Column:
    """Monday of the ISO week of ``c``; for a Monday, the Monday one week earlier."""
    return F.date_sub(F.next_day(F.date_sub(F.to_date(c), 1), "MON"), 7)


def plus_months_overflow(c, months: int) -> Column:
    """Add whole months letting the day overflow (Dec 31 + 2 months = Mar 2)."""
    d = F.to_date(c)
    return F.date_add(F.add_months(F.trunc(d, "MM"), months), F.dayofmonth(d) - 1)


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))
