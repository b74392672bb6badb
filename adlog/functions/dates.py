"""Date bounds accepted by the public API."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | int | dt.date | dt.datetime


def as_date(value: DateLike) -> dt.date:
    """Turn ``"2016-01-31"``, ``20160131``, ``"2016-01-31 04:00:00"`` or a date into a date.

    A time of day is dropped: windows are ranges of whole days, except where :func:`within` is used.
    """
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    if text.isdigit() and len(text) == 8:
        return dt.datetime.strptime(text, "%Y%m%d").date()
    return dt.date.fromisoformat(text[:10])


def time_of(value: DateLike) -> dt.datetime | None:
    """The moment a bound with a time of day names, or None for a whole day."""
    if isinstance(value, dt.datetime):
        return value
    text = str(value).strip()
    return dt.datetime.fromisoformat(text) if not isinstance(value, dt.date) and len(text) > 10 else None


def within(column: str, start: DateLike, end: DateLike) -> Column:
    """A timestamp within the bounds, both included: whole days, or to the moment where a bound has a time of day."""
    moment, day = F.col(column), F.col(column).cast("date")
    first, last = time_of(start), time_of(end)
    after = day >= F.lit(as_date(start)) if first is None else moment >= F.lit(first)
    before = day <= F.lit(as_date(end)) if last is None else moment <= F.lit(last)
    return after & before
