"""Event logs: spend, transactions and referrals of one channel as one wide table.

Each function returns one lazy plan. What it does in order of size:

1. conversions are cut to one row per user and given their keyword, campaign and cohort of new customers,
   all at the grain of users;
2. the transactions of those users meet the item table, once;
3. referral weeks meet the users who bought;
4. spend rows, which need no join at all, are put beside them.

``stage`` may write the transaction rows to a table and return it. Both the log and the referrals need those
rows, and without a stage Spark works them out twice. The search and the display log need the same ones:
:func:`event_logs` builds all three logs and works each set of rows out once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.channels import BING, SEARCH, Channel
from adlog.functions.dates import DateLike
from adlog.operators.attribution import (
    ACQUISITION_COLUMNS,
    add_week,
    attach_campaign_name,
    attach_keyword_name,
    attribute_referrals,
    campaign_lookup,
    clean_tags,
    date_transactions,
    drop_tracking_columns,
    event_log_union,
    first_acquisition,
    keyword_lookup,
    new_customers_only,
    one_conversion_per_user,
)
from adlog.operators.filters import filter_display_remarketing
from adlog.sources.events import channel_conversions
from adlog.sources.store import Store, first_transactions, referrals, transactions_extract

Stage = Callable[[DataFrame], DataFrame]


def acquisitions(
    events: DataFrame,
    store: Store,
    channel: Channel,
    campaigns: DataFrame,
    start: DateLike,
    end: DateLike,
    keywords: DataFrame | None = None,
) -> DataFrame:
    """One row per new customer with the click that brought them, ad tags cleaned and names attached.

    Tracking and personal columns go once the first conversion is chosen, so none of them meets the items or is staged.
    """
    conversions = drop_tracking_columns(one_conversion_per_user(channel_conversions(events, channel, start, end)))
    if keywords is not None:
        conversions = attach_keyword_name(conversions, keywords)
    named = attach_campaign_name(clean_tags(conversions, channel), campaigns)
    return new_customers_only(named, first_transactions(store, start, end))


def transaction_rows(store: Store, acquired: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """The sold items of new customers, with the click that brought each customer."""
    buyers = store.users.select("id", "name").join(acquired.withColumnRenamed("app_user_id", "id"), "id")
    return drop_tracking_columns(add_week(date_transactions(transactions_extract(store, start, end, buyers), start, end)))


def _sold(store: Store, acquired: DataFrame, start: DateLike, end: DateLike, stage: Stage | None) -> DataFrame:
    bought = transaction_rows(store, acquired, start, end)
    return bought if stage is None else stage(bought)


def assemble(
    spend: DataFrame, bought: DataFrame, store: Store, start: DateLike, end: DateLike, acquired: DataFrame | None = None
) -> DataFrame:
    """Transaction rows, spend rows and the referrals of the buyers, as one log.

    With ``acquired``, the new customers, what first brought a buyer is taken from there: every transaction of a user carries
    the same click, so the transaction rows need only say who bought, and that second pass over the items is a narrow one.
    Without it the rows themselves are asked, which is best when they are a staged table.
    """
    if acquired is None:
        brought = first_acquisition(bought)
    else:
        buyers = bought.select("user_id").distinct()
        clicks = acquired.select(F.col("app_user_id").alias("user_id"), *ACQUISITION_COLUMNS)
        brought = clicks.join(buyers, "user_id", "left_semi")
    referred = attribute_referrals(referrals(store), brought, start, end)
    return drop_tracking_columns(event_log_union(bought, add_week(spend), referred))


def search_event_log(
    keyword_report: DataFrame,
    campaign_report: DataFrame,
    events: DataFrame,
    store: Store,
    start: DateLike,
    end: DateLike,
    stage: Stage | None = None,
) -> DataFrame:
    """Event log of the search engine's keywords."""
    acquired = acquisitions(events, store, SEARCH, campaign_lookup(campaign_report), start, end)
    bought = _sold(store, acquired, start, end, stage)
    return assemble(keyword_report, bought, store, start, end, acquired if stage is None else None)


def bing_event_log(
    keyword_report: DataFrame,
    events: DataFrame,
    store: Store,
    start: DateLike,
    end: DateLike,
    stage: Stage | None = None,
) -> DataFrame:
    """Event log of the second engine's keywords; names of campaigns and keywords come from its own report."""
    acquired = acquisitions(
        events, store, BING, campaign_lookup(keyword_report), start, end, keyword_lookup(keyword_report)
    )
    bought = _sold(store, acquired, start, end, stage)
    return assemble(keyword_report, bought, store, start, end, acquired if stage is None else None)


def display_event_log(
    campaign_report: DataFrame,
    events: DataFrame,
    store: Store,
    start: DateLike,
    end: DateLike,
    stage: Stage | None = None,
) -> DataFrame:
    """Event log of the remarketing display campaigns.

    It uses the same conversions as the search log, so the two hold some transactions in common: do not add
    them up.
    """
    acquired = acquisitions(events, store, SEARCH, campaign_lookup(campaign_report), start, end)
    bought = _sold(store, acquired, start, end, stage)
    log = assemble(campaign_report, bought, store, start, end, acquired if stage is None else None)
    return filter_display_remarketing(log)


@dataclass(frozen=True)
class Sources:
    """Clean reports, flat events and the store: what the logs are made of."""

    search_keywords: DataFrame
    campaigns: DataFrame
    bing_keywords: DataFrame
    events: DataFrame
    store: Store


@dataclass(frozen=True)
class EventLogs:
    search: DataFrame
    bing: DataFrame
    display: DataFrame


def event_logs(sources: Sources, start: DateLike, end: DateLike, stage: Stage | None = None) -> EventLogs:
    """The logs of all channels; the search and the display log share their transaction rows."""
    store, events = sources.store, sources.events
    acquired = acquisitions(events, store, SEARCH, campaign_lookup(sources.campaigns), start, end)
    bought = _sold(store, acquired, start, end, stage)
    known = acquired if stage is None else None
    return EventLogs(
        search=assemble(sources.search_keywords, bought, store, start, end, known),
        bing=bing_event_log(sources.bing_keywords, events, store, start, end, stage),
        display=filter_display_remarketing(assemble(sources.campaigns, bought, store, start, end, known)),
    )
