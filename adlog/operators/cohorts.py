"""Acquisition cohorts of one keyword.

A user belongs to the cohort of the first week they appear in; a row without a user belongs to its own week.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlog.functions import scalars
from adlog.functions.aggregates import CENTS
from adlog.functions.joins import left_join_spreading_nulls
from adlog.operators.filters import filter_keyword, monetary_rows
from adlog.operators.kpis import MARGIN
from adlog.operators.series import cumulative, sum_by_week, unpivot_metrics


def week_ordinal(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """The weeks of the log, numbered from 1 in calendar order.

    The numbering runs in one task, over one row per calendar week.
    """
    weeks = filter_keyword(elog, keyword).select("week").distinct()
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("week"))).cast("long")
    return weeks.select("week", number.alias("week_number"))


def cohort_assignment(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """Every row with its ``week_number``, ``cohort_week`` and cohort label.

    Users are grouped, not windowed: spend rows have no user, and a window would put all of them together. The
    numbered weeks are broadcast: they are at most one row per week of the calendar.
    """
    rows = filter_keyword(elog, keyword)
    weeks = F.broadcast(week_ordinal(rows).withColumnRenamed("week", "numbered_week"))

    def numbered(frame: DataFrame) -> DataFrame:
        """With the week's number; rows without a week are of the last one, as in :func:`cohort_weeks`."""
        return frame.join(weeks, F.col("week").eqNullSafe(F.col("numbered_week"))).drop("numbered_week")

    first = monetary_rows(rows).groupBy("user_id").agg(F.min("week").alias("week"))
    cohorts = numbered(first).select("user_id", F.col("week_number").alias("cohort_week"))
    # Narrow columns that tell spend rows apart; staged logs have names of campaigns only.
    campaign = "campaign_id" if "campaign_id" in rows.columns else "campaign_name"
    spread_by = [name for name in ("week", "date", campaign) if name in rows.columns][-2:]
    placed = left_join_spreading_nulls(numbered(rows), cohorts, "user_id", spread_by)
    cohort_week = F.coalesce("cohort_week", "week_number")
    return placed.withColumn("cohort_week", cohort_week).withColumn("cohort", scalars.cohort_label(F.col("cohort_week")))


def cohort_weeks(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """Cents spent and earned per cohort and week, both numbered.

    The log is read once: it is summed per user and week, the cohort is found among the weeks of a user, and
    weeks are numbered on what is left after a second sum, at most one row per pair of calendar weeks.
    """
    per_user = sum_by_week(filter_keyword(elog, keyword), "user_id")
    first_week = F.min("week").over(Window.partitionBy("user_id"))
    started = per_user.withColumn("start", F.when(F.col("user_id").isNull(), F.col("week")).otherwise(first_week))
    per_cohort = started.groupBy("start", "week").agg(
        F.sum("cost_cents").alias("cost_cents"), F.sum("earned_cents").alias("earned_cents")
    )
    numbered = per_cohort.withColumn(
        "week_number", F.dense_rank().over(Window.orderBy(F.asc_nulls_last("week"))).cast("long")
    )
    # A cohort's first week is the week it is named after.
    return numbered.withColumn("cohort_week", F.min("week_number").over(Window.partitionBy("start"))).select(
        "cohort_week", "week_number", "cost_cents", "earned_cents"
    )


def cohort_roi_merge(totals: DataFrame) -> DataFrame:
    """Cost and contribution of each cohort as rows, with the cohort's return beside them."""
    return unpivot_metrics(totals, ["cohort_week", "cohort_ROI"], ["cohort_cost", "cohort_contribution"]).select(
        "cohort_week", "type", "value", "cohort_ROI"
    )


def cohort_totals(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """Total cost (as a negative number), contribution and return of each cohort."""
    return totals_of(cohort_weeks(elog, keyword))


def totals_of(weeks: DataFrame) -> DataFrame:
    sums = weeks.groupBy("cohort_week").agg(
        (F.sum("cost_cents") / CENTS).alias("spent"),
        (F.sum("earned_cents") / CENTS * MARGIN).alias("cohort_contribution"),
    )
    totals = sums.select(
        "cohort_week",
        (-F.col("spent")).alias("cohort_cost"),
        "cohort_contribution",
        (F.col("cohort_contribution") - F.col("spent")).alias("cohort_ROI"),
    )
    return cohort_roi_merge(totals).orderBy("cohort_week", F.desc("type"))


def cohort_performance_over_time(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """Running cost, contribution and return of each cohort."""
    return performance_of(cohort_weeks(elog, keyword))


def performance_of(weeks: DataFrame) -> DataFrame:
    return cumulative(weeks, "cohort_week", order="week_number")


def cohort_breakeven(elog: DataFrame, keyword: str | None = None) -> DataFrame:
    """Each cohort's running return, the weeks it turns positive, and the number of weeks that took.

    A cohort turns positive in a week that ends above zero after one that ended below, or that is its first.
    The first such week counts; a cohort without one has no number of weeks.
    """
    return breakeven_of(cohort_weeks(elog, keyword))


def breakeven_of(weeks: DataFrame) -> DataFrame:
    running = performance_of(weeks).filter(F.col("type") == "cum_ROI")
    in_order = Window.partitionBy("cohort_week").orderBy("week_number")
    whole = Window.partitionBy("cohort_week")
    before = F.lag("value").over(in_order)
    turned = (F.col("value") > 0) & (before.isNull() | (before < 0))
    flagged = running.withColumn("breakeven_week", F.when(turned, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    first = F.min(F.when(F.col("breakeven_week") == 1, F.col("week_number"))).over(whole)
    return flagged.withColumn("weeks_until_breakeven", first - F.min("week_number").over(whole) + 1)


def cohort_views(
    elog: DataFrame, keyword: str, stage: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All cohort frames of one keyword. With a ``stage`` for their common part the log is read once."""
    weeks = cohort_weeks(elog, keyword)
    if stage is not None:
        weeks = stage(weeks)
    return {
        "cohort_totals": totals_of(weeks),
        "cohort_performance_over_time": performance_of(weeks),
        "cohort_breakeven": breakeven_of(weeks),
    }
