"""Keyword, campaign, user and customer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.channels import SEARCH, Channel
from adlog.functions import scalars
from adlog.functions.aggregates import CENTS, sum_cents, sum_count, sum_money, zero_if_null
from adlog.operators.filters import filter_campaign, filter_earning, filter_keyword, monetary_rows
from adlog.operators.kpis import MARGIN, summarize_elog

MATCHTYPE_KEYS = ["keyword", "campaign_name", "match_type"]
METRIC_KEYS = ["keyword", "campaign_name", "week"]


def _select(elog: DataFrame, keyword: str | None, campaign: str | None) -> DataFrame:
    return filter_campaign(filter_keyword(elog, keyword), campaign)


def keywords_report(
    elog: DataFrame, keyword: str | None = None, campaign: str | None = None, channel: Channel = SEARCH, **kpi
) -> DataFrame:
    """KPIs per keyword."""
    return summarize_elog(_select(elog, keyword, campaign), "keyword", channel=channel, **kpi)


def keywords_with_earnings(
    elog: DataFrame, campaign: str | None = None, channel: Channel = SEARCH, **kpi
) -> DataFrame:
    """KPIs of the keywords that earned anything."""
    return filter_earning(keywords_report(elog, campaign=campaign, channel=channel, **kpi))


def matchtype_summary(
    elog: DataFrame, keyword: str | None = None, campaign: str | None = None, channel: Channel = SEARCH, **kpi
) -> DataFrame:
    """KPIs per keyword, campaign and match type."""
    rows = _select(elog, keyword, campaign)
    return summarize_elog(rows, *MATCHTYPE_KEYS, channel=channel, **kpi)


def keyword_campaign_matchtype_report(elog: DataFrame, *args, **kwargs) -> DataFrame:
    """:func:`matchtype_summary`, best earners first."""
    return best_earners_first(matchtype_summary(elog, *args, **kwargs))


def best_earners_first(summary: DataFrame) -> DataFrame:
    """Sorted by earnings; the keys after them keep the many rows that earned nothing from ending up in one task."""
    return summary.orderBy(F.desc("earnings"), *[F.asc_nulls_last(key) for key in MATCHTYPE_KEYS])


def contribution_per_click(elog: DataFrame, *args, **kwargs) -> DataFrame:
    """What a click on a paid and earning keyword contributes, and the bid that would return it twice.

    Takes what :func:`matchtype_summary` takes.
    """
    return contribution_of(matchtype_summary(elog, *args, **kwargs))


def contribution_of(summary: DataFrame) -> DataFrame:
    return filter_earning(summary, paid_only=True).select(
        "campaign_name",
        "keyword",
        "match_type",
        F.col("cost").alias("total_cost"),
        F.col("contribution").alias("total_contribution"),
        F.col("clicks").alias("total_clicks"),
        "contribution_per_click",
        (F.col("contribution_per_click") / 2).alias("cpc_bid_for_2x_ROAS"),
    )


def weekly_conversion_metrics(
    elog: DataFrame, campaign: str | None = None, channel: Channel = SEARCH, **kpi
) -> DataFrame:
    """Click-through, conversion and impression share per keyword, campaign and week, sorted by them."""
    return by_keyword_campaign_week(weekly_metrics(elog, campaign, channel, **kpi))


def by_keyword_campaign_week(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(*[F.asc_nulls_last(key) for key in METRIC_KEYS])


def weekly_metrics(elog: DataFrame, campaign: str | None = None, channel: Channel = SEARCH, **kpi) -> DataFrame:
    """:func:`weekly_conversion_metrics` in no order."""
    weekly = filter_campaign(summarize_elog(elog, *METRIC_KEYS, channel=channel, **kpi), campaign)
    share = ["est_search_impression_share"] if channel.has_impression_share else []
    if share:
        weekly = weekly.withColumn(share[0], scalars.capped_share(F.col(share[0])))
    return weekly.select(
        *METRIC_KEYS,
        *share,
        "impressions",
        "clicks",
        "num_acquisitions",
        "click_through_rate",
        "conversion_rate",
        "cost_per_click",
        "contribution_per_click",
    )


def user_overview(elog: DataFrame) -> DataFrame:
    """Per user: what brought them, what they earned, what the users they referred earned.

    Sums are taken per user and name set first, where they stay in a hash aggregate; the names, which are
    strings, are then picked from about two rows per user. Every row of the user counts, referrals too.
    """
    names = ["user_name", "campaign_name", "keyword"]
    per_source = (
        monetary_rows(elog)
        .groupBy("user_id", *names)
        .agg(
            F.count("*").alias("rows"),
            sum_cents(F.col("money_in_the_bank_paid_to_us")).alias("earned_cents"),
            sum_count(F.col("new_referred_users")).alias("referred_users"),
            sum_cents(F.col("referred_users_transaction_amount")).alias("referred_cents"),
        )
    )
    users = per_source.groupBy("user_id").agg(
        F.max("user_name").alias("name"),
        F.sum("rows").alias("num_transactions"),
        (F.sum("earned_cents") / CENTS).alias("earnings"),
        F.max("campaign_name").alias("campaign_name"),
        F.max("keyword").alias("keyword"),
        F.sum("referred_users").alias("referred_users"),
        (F.sum("referred_cents") / CENTS).alias("referred_earnings"),
    )
    contribution = F.col("earnings") * MARGIN
    referred_contribution = F.col("referred_earnings") * MARGIN
    return users.select(
        "user_id",
        "name",
        "num_transactions",
        "earnings",
        contribution.alias("contribution"),
        "campaign_name",
        "keyword",
        "referred_users",
        "referred_earnings",
        referred_contribution.alias("referred_contribution"),
        (F.col("earnings") + F.col("referred_earnings")).alias("total_earnings"),
        (contribution + referred_contribution).alias("total_contribution"),
    )


def customers_per_month(elog: DataFrame, keyword: str | None = None, campaign: str | None = None) -> DataFrame:
    """New customers per month; a customer counts in the month of their first row."""
    first_weeks = (
        monetary_rows(_select(elog, keyword, campaign)).groupBy("user_id").agg(F.min("week").alias("first_week"))
    )
    return (
        first_weeks.groupBy(scalars.month_bucket(F.col("first_week")).alias("month"))
        .agg(F.count("*").alias("num_acquisitions"))
        .select(scalars.month_label(F.col("month")).alias("first_transaction_month"), "num_acquisitions")
    )


def total_customers_per_month(search: DataFrame, bing: DataFrame) -> DataFrame:
    """Both engines' :func:`customers_per_month` side by side; a month one engine lacks counts 0 there."""
    month = "first_transaction_month"
    joined = search.withColumnRenamed("num_acquisitions", "num_acquisitions_search").join(
        bing.withColumnRenamed("num_acquisitions", "num_acquisitions_bing"), month, "full"
    )
    in_search = zero_if_null(F.col("num_acquisitions_search"))
    in_bing = zero_if_null(F.col("num_acquisitions_bing"))
    return joined.select(
        month,
        in_search.alias("num_acquisitions_search"),
        in_bing.alias("num_acquisitions_bing"),
        (in_search + in_bing).alias("total_acquisitions"),
    )


def orders_per_week(elog: DataFrame, keyword: str | None = None, campaign: str | None = None) -> DataFrame:
    """Cost, contribution and the number of different buyers per week and campaign."""
    return (
        _select(elog, keyword, campaign)
        .groupBy("week", "campaign_name")
        .agg(
            sum_money(F.col("cost")).alias("cost"),
            (sum_money(F.col("money_in_the_bank_paid_to_us")) * MARGIN).alias("contribution"),
            F.countDistinct("user_name").alias("num_orders"),
        )
    )
