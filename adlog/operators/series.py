"""Weekly cumulative cost, contribution and return.

Rows are first summed per key and week, so the windows below run over at most one row per week of the
calendar and key, however large one key's share of the event log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlog import schemas
from adlog.functions.aggregates import CENTS, sum_cents, sum_money
from adlog.operators.filters import device_slice, filter_campaign, filter_keyword
from adlog.operators.kpis import MARGIN

WEEKLY_KEYS = ["keyword", "campaign_name", "device", "week"]


def weekly_totals(elog: DataFrame) -> DataFrame:
    """The event log summed to keyword, campaign, device and week.

    It has the columns every series here needs, so it can stand in for the event log when several series
    are wanted: the log is then read once.
    """
    return elog.groupBy(*WEEKLY_KEYS).agg(
        *[sum_money(F.col(name)).cast(schemas.MONEY).alias(name) for name in ("cost", "money_in_the_bank_paid_to_us")]
    )


def sum_by_week(elog: DataFrame, *keys: str) -> DataFrame:
    """Cents spent and earned per key and week."""
    return elog.groupBy(*keys, "week").agg(
        sum_cents(F.col("cost")).alias("cost_cents"),
        sum_cents(F.col("money_in_the_bank_paid_to_us")).alias("earned_cents"),
    )


def unpivot_metrics(wide: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric, as ``type`` and ``value``."""
    return wide.unpivot(ids, metrics, "type", "value")


def cumulative(
    totals: DataFrame, *keys: str, order: str = "week", roi: str = "cum_ROI", margin: float = MARGIN
) -> DataFrame:
    """Running cost, contribution and their difference within ``keys``, in long form.

    ``totals`` has one row per key and ``order``, in cents, as :func:`sum_by_week` makes them.
    """
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(F.asc_nulls_last(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cum_cost = F.sum("cost_cents").over(so_far) / CENTS
    cum_contribution = F.sum("earned_cents").over(so_far) / CENTS * margin
    wide = totals.select(
        *keys,
        order,
        (F.col("cost_cents") / CENTS).alias("cost"),
        (F.col("earned_cents") / CENTS * margin).alias("contribution"),
        cum_cost.alias("cum_cost"),
        cum_contribution.alias("cum_contribution"),
    ).withColumn(roi, F.col("cum_contribution") - F.col("cum_cost"))
    return unpivot_metrics(wide, [*keys, order, "cost", "contribution"], ["cum_cost", "cum_contribution", roi])


def keep_earning_keywords(totals: DataFrame) -> DataFrame:
    """Weekly totals of the keywords that earned anything over all their rows.

    The same as a semi-join with the earning keywords, without reading the event log a second time. For totals
    with few rows per keyword and week only: all of a keyword's rows meet in one task.
    """
    earned = F.sum("earned_cents").over(Window.partitionBy("keyword"))
    return totals.withColumn("__earned", earned).filter(F.col("__earned") > 0).drop("__earned")


def earning_keywords_only(rows: DataFrame, elog: DataFrame | None = None) -> DataFrame:
    """Rows of the keywords that earned anything in ``elog`` (by default in ``rows`` themselves).

    A NULL keyword counts as a keyword.
    """
    earning = (
        (rows if elog is None else elog)
        .groupBy(F.col("keyword").alias("earning_keyword"))
        .agg(sum_cents(F.col("money_in_the_bank_paid_to_us")).alias("earned_cents"))
        .filter(F.col("earned_cents") > 0)
        .select("earning_keyword")
    )
    return rows.join(earning, F.col("keyword").eqNullSafe(F.col("earning_keyword")), "left_semi")


def overall_performance_over_time(elog: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Is total ad spend paying back, week by week?"""
    series = cumulative(sum_by_week(elog), roi="cum_ROAS", margin=margin)
    return series.select("week", "type", "value")


def keywords_performance_over_time(elog: DataFrame) -> DataFrame:
    """The series of each earning keyword."""
    return cumulative(keep_earning_keywords(sum_by_week(elog, "keyword")), "keyword")


def keywords_campaign_performance_over_time(elog: DataFrame) -> DataFrame:
    """The series of each earning keyword in each campaign.

    A keyword may run in any number of campaigns, so its rows are not brought together: the earning keywords are found by
    adding up the totals, and joined to them. The log is read once: both uses of the totals have the same columns, so that
    Spark shares their shuffle.
    """
    totals = sum_by_week(elog, "keyword", "campaign_name")
    by_keyword = totals.groupBy(F.col("keyword").alias("earning_keyword")).agg(
        F.sum("earned_cents").alias("earned_cents"), F.sum("cost_cents").alias("cost_cents")
    )
    # Spent cents are never NULL; naming them keeps the column in this use as well.
    earning = by_keyword.filter((F.col("earned_cents") > 0) & F.col("cost_cents").isNotNull()).select("earning_keyword")
    earned = totals.join(earning, F.col("keyword").eqNullSafe(F.col("earning_keyword")), "left_semi")
    return cumulative(earned, "keyword", "campaign_name")


def device_performance_over_time(
    elog: DataFrame,
    keyword: str | None = None,
    campaign: str | None = None,
    device: str | None = None,
    earning_only: bool = False,
) -> DataFrame:
    """The series of each keyword on each device; on one device, or of earning keywords only, if asked."""
    totals = sum_by_week(filter_campaign(filter_keyword(elog, keyword), campaign), "keyword", "device")
    if earning_only:
        totals = keep_earning_keywords(totals)
    if device is not None:
        totals = device_slice(totals, device)
    return cumulative(totals, "keyword", "device")


def display_device_performance(elog: DataFrame, campaign: str | None = None, device: str | None = None) -> DataFrame:
    """The series of each device, for a display event log."""
    totals = sum_by_week(filter_campaign(elog, campaign), "device")
    if device is not None:
        totals = device_slice(totals, device)
    return cumulative(totals, "device")
