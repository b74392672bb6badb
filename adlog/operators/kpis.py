"""The KPI summary of an event log, for any grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.channels import SEARCH, Channel
from adlog.functions.aggregates import ratio, sum_available, sum_count, sum_money, weighted_mean

# Assumptions behind the value figures.
MARGIN = 0.25
ORDERS_IN_LIFETIME = 10
VALUE_PER_ORDER = 70


def summarize_elog(
    elog: DataFrame,
    *keys: str,
    channel: Channel = SEARCH,
    margin: float = MARGIN,
    orders_in_lifetime: float = ORDERS_IN_LIFETIME,
    value_per_order: float = VALUE_PER_ORDER,
) -> DataFrame:
    """Spend, traffic, acquisition, earnings and return per group (all rows as one group without keys).

    The sums come from one aggregate; the ratios are a projection of it. Catalyst drops the sums a caller
    does not select, so reports can build on this without paying for all of it.
    """
    sums = {
        "cost": sum_money(F.col("cost")),
        "average_position": weighted_mean(F.col("average_position"), F.col("impressions")),
        "impressions": sum_count(F.col("impressions")),
        "clicks": sum_count(F.col("clicks")),
        "num_acquisitions": F.countDistinct("user_id"),
        "earnings": sum_money(F.col("money_in_the_bank_paid_to_us")),
        "referred_users": F.lit(None).cast("long"),
        "referred_earnings": F.lit(None).cast("double"),
    }
    if channel.has_impression_share:
        sums["estimated_available_impressions"] = sum_available(
            F.col("impressions"), F.col("est_search_impression_share")
        )
    if "new_referred_users" in elog.columns:
        sums["referred_users"] = sum_count(F.col("new_referred_users"))
    if "referred_users_transaction_amount" in elog.columns:
        sums["referred_earnings"] = sum_money(F.col("referred_users_transaction_amount"))
    totals = elog.groupBy(*keys).agg(*[value.alias(name) for name, value in sums.items()])
    return kpi_figures(totals, *keys, channel=channel, margin=margin, orders_in_lifetime=orders_in_lifetime, value_per_order=value_per_order)


def kpi_figures(
    totals: DataFrame,
    *keys: str,
    channel: Channel = SEARCH,
    margin: float = MARGIN,
    orders_in_lifetime: float = ORDERS_IN_LIFETIME,
    value_per_order: float = VALUE_PER_ORDER,
) -> DataFrame:
    """The figures of a summary from its sums: a projection."""
    cost, clicks, impressions = F.col("cost"), F.col("clicks"), F.col("impressions")
    acquired, earnings = F.col("num_acquisitions"), F.col("earnings")
    contribution = earnings * margin
    lifetime_value = acquired * float(orders_in_lifetime) * float(value_per_order) * margin
    total_earnings = earnings + F.col("referred_earnings")
    total_contribution = total_earnings * margin
    share = {}
    if channel.has_impression_share:
        available = F.col("estimated_available_impressions")
        share = {
            "estimated_available_impressions": available,
            "est_search_impression_share": ratio(impressions, available),
        }
    figures = {
        "cost": cost,
        "average_position": F.col("average_position"),
        "impressions": impressions,
        **share,
        "clicks": clicks,
        "click_through_rate": ratio(clicks, impressions),
        "num_acquisitions": acquired,
        "conversion_rate": ratio(acquired, clicks),
        "cost_per_click": ratio(cost, clicks),
        "earnings": earnings,
        "contribution": contribution,
        "earnings_per_click": ratio(earnings, clicks),
        "contribution_per_click": ratio(contribution, clicks),
        "cpa": F.when(acquired == 0, cost).otherwise(ratio(cost, acquired)),
        "referred_users": F.col("referred_users"),
        "referred_earnings": F.col("referred_earnings"),
        "estimated_ltv": lifetime_value,
        "estimated_lifetime_ROAS": ratio(lifetime_value - cost, cost),
        "total_earnings": total_earnings,
        "total_contribution": total_contribution,
        "actual_ROAS": ratio(total_contribution - cost, cost),
    }
    return totals.select(*keys, *[value.alias(name) for name, value in figures.items()])
