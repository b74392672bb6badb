"""Who brought which customer: conversions, lookups and referral attribution.

Attribution is by user alone, never by time. A user has one conversion, and every transaction of that user
carries its keyword, campaign, device and match type. All of this is therefore worked out at the grain of
one row per user, before the transactions are touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlog import schemas
from adlog.channels import Channel
from adlog.functions import scalars
from adlog.functions.dates import DateLike
from adlog.functions.joins import left_join_spreading_nulls
from adlog.operators.filters import date_filter, monetary_rows, referral_window

ACQUISITION_COLUMNS = ["keyword", "campaign_name", "campaign_id", "device", "match_type"]
# Narrow columns that tell conversions apart, also once there is one for each user.
CONVERSION_ROWS = ("app_user_id", "orderId")


def one_conversion_per_user(conversions: DataFrame) -> DataFrame:
    """The first conversion of each user, by time, then by order, then by all its other columns, so that an order that
    was sent twice makes no random choice. Rows without a user are one user, as in a group.

    Spark cuts each map task down to one row per user before the shuffle (``WindowGroupLimit``), so a user
    with very many conversions costs no more than another.
    """
    rest = sorted(set(conversions.columns) - {"app_user_id", "time", "orderId"})
    by_time = Window.partitionBy("app_user_id").orderBy(*[F.asc_nulls_last(name) for name in ("time", "orderId", *rest)])
    ranked = conversions.withColumn("__rank", F.row_number().over(by_time))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def name_lookup(rows: DataFrame, key: str, name: str) -> DataFrame:
    """One ``name`` per ``key``: the smallest, so that the choice does not depend on row order.

    Pairs are made distinct first, in a hash aggregate that shrinks the rows before anything is shuffled.
    """
    pairs = rows.filter(F.col(key).isNotNull()).select(key, name).distinct()
    return pairs.groupBy(key).agg(F.min(name).alias(name))


def campaign_lookup(spend: DataFrame) -> DataFrame:
    return name_lookup(spend, "campaign_id", "campaign_name")


def keyword_lookup(spend: DataFrame) -> DataFrame:
    return name_lookup(spend, "keyword_id", "keyword")


def attach_campaign_name(
    rows: DataFrame, lookup: DataFrame, spread_by: Sequence[str] = CONVERSION_ROWS
) -> DataFrame:
    """Rows with their campaign's name; rows without a known campaign stay, with a NULL name.

    ``spread_by`` names narrow columns that tell the rows apart; by default those of conversions.
    """
    return left_join_spreading_nulls(rows, lookup, "campaign_id", spread_by)


def attach_keyword_name(
    conversions: DataFrame, lookup: DataFrame, spread_by: Sequence[str] = CONVERSION_ROWS
) -> DataFrame:
    """Conversions with the keyword their ``kwd-`` tag stands for, in place of the tag."""
    tagged = conversions.withColumn("keyword_id", scalars.keyword_id_from_tag(F.col("latest_ad_awkeyword")))
    return left_join_spreading_nulls(tagged.drop("latest_ad_awkeyword"), lookup, "keyword_id", spread_by)


def clean_tags(rows: DataFrame, channel: Channel) -> DataFrame:
    """Ad-tag columns under their event-log names, with numeric ids and normal spellings.

    ``keyword`` is taken from the tag unless a lookup has already put it there.
    """
    renamed = rows.withColumnsRenamed(
        {
            "latest_ad_device": "device",
            "latest_ad_utm_campaign": "campaign_id",
            "latest_ad_awkeyword": "keyword",
            "latest_ad_awadgroupid": "ad_group_id",
            "latest_ad_awmatchtype": "match_type",
        }
    )
    return renamed.withColumns(
        {
            "campaign_id": scalars.whole_number(F.col("campaign_id")),
            "ad_group_id": scalars.whole_number(F.col("ad_group_id")),
            "match_type": scalars.normalize_match_type(F.col("match_type")),
            "keyword": channel.keyword(F.col("keyword")),
        }
    )


def date_transactions(rows: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Transactions with ``user_id``, ``date`` and weekday, cut to the dates."""
    dated = rows.withColumnRenamed("app_user_id", "user_id").withColumns(
        {
            "user_id": scalars.whole_number(F.col("user_id")),
            "date": F.col("transaction_date").cast("date"),
        }
    )
    return date_filter(dated.withColumn("day_of_week", scalars.day_of_week(F.col("date"))), start, end)


def clean_transactions(rows: DataFrame, channel: Channel, start: DateLike, end: DateLike) -> DataFrame:
    """Transactions joined with their conversions, in event-log form."""
    return date_transactions(clean_tags(rows, channel), start, end)


def join_conversions(transactions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Transactions of users who have a conversion, with the conversion's columns."""
    return transactions.join(conversions, "app_user_id")


def new_customers_only(rows: DataFrame, first_transactions: DataFrame) -> DataFrame:
    """Rows of users whose first order is one of ``first_transactions``."""
    users = first_transactions.select(F.col("id").alias("app_user_id"))
    return rows.join(users, "app_user_id", "left_semi")


def first_acquisition(elog: DataFrame) -> DataFrame:
    """Per user, what first brought them: keyword, campaign, device and match type of their earliest week.

    Equal rows are merged in a hash aggregate first, so that the pick among rows, which has to compare
    strings, sees about one row per user.
    """
    per_source = (
        monetary_rows(elog).groupBy("user_id", *ACQUISITION_COLUMNS).agg(F.min("week").alias("first_week"))
    )
    earliest = F.min(F.struct(_nulls_last("first_week"), "first_week", *ACQUISITION_COLUMNS)).alias("first")
    return (
        per_source.groupBy("user_id").agg(earliest).select("user_id", *[f"first.{name}" for name in ACQUISITION_COLUMNS])
    )


def _nulls_last(name: str) -> Column:
    return F.col(name).isNull().alias("__no_" + name)


def attribute_referrals(
    weekly_metrics: DataFrame, acquisitions: DataFrame, start: DateLike, end: DateLike
) -> DataFrame:
    """Weekly referral metrics of acquired users, with what first brought those users."""
    weekly = weekly_metrics.withColumnsRenamed({"week_start": "week", "influencer_id": "user_id"}).withColumn(
        "week", F.col("week").cast("date")
    )
    return referral_window(weekly, start, end).join(acquisitions, "user_id")


def event_log_union(*parts: DataFrame) -> DataFrame:
    """All rows of all parts by column name; columns a part lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def add_week(rows: DataFrame) -> DataFrame:
    return rows.withColumn("week", scalars.monday_week(F.col("date")))


def drop_tracking_columns(elog: DataFrame) -> DataFrame:
    return elog.drop(*schemas.TRACKING_COLUMNS)
