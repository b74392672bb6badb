"""Row filters. Each is one predicate, so Catalyst moves it to the scan or below the aggregate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.functions.dates import DateLike, as_date

# What marks a remarketing campaign, and the device codes.
REMARKETING_PATTERN = "Rmktg"
DESKTOP = "dt"
MOBILE = "mb"


def date_filter(rows: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included; each defaults to today."""
    today = dt.date.today()
    first = today if start is None else as_date(start)
    last = today if end is None else as_date(end)
    return rows.filter(F.col("date").between(F.lit(first), F.lit(last)))


def date_window(rows: DataFrame, start: DateLike | None, end: DateLike | None) -> DataFrame:
    """Rows dated within the bounds, both included; all rows if both are None, as when files are loaded."""
    return rows if start is None and end is None else date_filter(rows, start, end)


def filter_keyword(elog: DataFrame, keyword: str | None) -> DataFrame:
    """Rows of exactly this keyword; all rows for None."""
    return elog if keyword is None else elog.filter(F.col("keyword") == keyword)


def filter_campaign(elog: DataFrame, pattern: str | None) -> DataFrame:
    """Rows whose campaign name contains a match of the pattern; all rows for None."""
    return elog if pattern is None else elog.filter(F.col("campaign_name").rlike(pattern))


def filter_earning(summary: DataFrame, paid_only: bool = False) -> DataFrame:
    """Summary rows with earnings, and with cost as well if ``paid_only``."""
    earning = F.col("earnings") > 0
    return summary.filter(earning & (F.col("cost") > 0) if paid_only else earning)


def filter_display_remarketing(elog: DataFrame) -> DataFrame:
    return filter_campaign(elog, REMARKETING_PATTERN)


def recent_weeks(rows: DataFrame, as_of: DateLike, keyword: str, weeks: int = 4) -> DataFrame:
    """Rows of one keyword in the ``weeks`` weeks up to ``as_of``."""
    last = as_date(as_of)
    first = last - dt.timedelta(weeks=weeks)
    return filter_keyword(rows.filter(F.col("week").between(F.lit(first), F.lit(last))), keyword)


def device_slice(rows: DataFrame, device: str) -> DataFrame:
    return rows.filter(F.col("device") == device)


def monetary_rows(elog: DataFrame) -> DataFrame:
    """Rows that belong to a user: transactions and referrals, not spend."""
    return elog.filter(F.col("user_id").isNotNull())


def referral_window(referrals: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Referral weeks that start within the dates."""
    return referrals.filter(F.col("week").between(F.lit(as_date(start)), F.lit(as_date(end))))
