"""Store tables: sold items, first orders, weekly referral metrics, staged campaigns."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog import schemas
from adlog.functions.dates import DateLike, as_date, within
from adlog.functions.joins import left_join_spreading_nulls


@dataclass(frozen=True)
class Store:
    """The order application's tables."""

    transactions: DataFrame
    transaction_items: DataFrame
    discounts: DataFrame
    users: DataFrame
    referrals: DataFrame


@dataclass(frozen=True)
class KeptStore(Store):
    """A store with each user's first order at hand (``id, first_transaction``), see :mod:`adlog.sources.snapshot`."""

    first_orders: DataFrame


# Labels of the kinds of purchase.
GIFT_CARD = "GiftCard"
GIFT_CARD_PURCHASE = "Gift Card"
RECURRING_PURCHASE = "Recurring Food Purchase"
SINGLE_PURCHASE = "One-Time Meal Purchase"


def transactions_extract(store: Store, start: DateLike, end: DateLike, users: DataFrame | None = None) -> DataFrame:
    """One row per item of every complete transaction in the window, with its user and money columns.

    The window runs to midnight after ``end``, both ends included. ``users`` stands in for the user table:
    only its users' transactions are read on, and its other columns come along.

    Transactions meet the users before the items, so the largest table is joined once, by transaction,
    against the transactions that count.
    """
    first, last = as_date(start), as_date(end) + dt.timedelta(days=1)
    buyers = (store.users if users is None else users).withColumnsRenamed({"id": "app_user_id", "name": "user_name"})
    carried = [name for name in buyers.columns if name not in ("app_user_id", "user_name")]

    transactions = store.transactions.filter(
        F.col("created_at").between(F.lit(first), F.lit(last)) & F.col("complete")
    ).select(
        F.col("id").alias("transaction_id"),
        F.col("user_id").alias("app_user_id"),
        F.col("created_at").alias("transaction_date"),
        "discount_amount",
        "credit",
        "sales_tax_amount",
        "refunded",
    )
    items = store.transaction_items.select("transaction_id", "discount_id", "price", "recurring")
    discounts = store.discounts.select(
        F.col("id").alias("discount_id"), F.col("type").alias("discount_type"), F.col("amount").alias("card_amount")
    )

    sold = transactions.join(buyers, "app_user_id").join(items, "transaction_id")
    sold = left_join_spreading_nulls(sold, discounts, "discount_id", ["transaction_id", "price"])

    price, tax, discount = F.col("price"), F.col("sales_tax_amount"), F.col("discount_amount")
    is_card = F.col("discount_type") == GIFT_CARD
    refunded = F.col("refunded")
    nothing = F.lit(0).cast(schemas.MONEY)
    return sold.select(
        "transaction_date",
        "user_name",
        "app_user_id",
        "discount_amount",
        "credit",
        "sales_tax_amount",
        F.when(refunded, price).otherwise(nothing).cast(schemas.MONEY).alias("refund_amount"),
        F.when(is_card, F.col("card_amount")).otherwise(price - tax + discount).cast(schemas.MONEY).alias("retail_price"),
        F.when(refunded, nothing)
        .when(F.col("credit") > 0, price - F.col("credit"))
        .otherwise(price)
        .cast(schemas.MONEY)
        .alias("money_in_the_bank_paid_to_us"),
        F.when(is_card, GIFT_CARD_PURCHASE)
        .when(F.col("recurring"), RECURRING_PURCHASE)
        .otherwise(SINGLE_PURCHASE)
        .alias("purchase_type"),
        *carried,
    )


def first_transactions(store: Store, start: DateLike, end: DateLike) -> DataFrame:
    """Ids of users whose very first transaction, complete or not, falls within the bounds, and its time.

    Bounds are whole days; a bound with a time of day counts to that time. A :class:`KeptStore` is not asked for its
    transactions.
    """
    if isinstance(store, KeptStore):
        first = store.first_orders
    else:
        first = store.transactions.groupBy(F.col("user_id").alias("id")).agg(F.min("created_at").alias("first_transaction"))
    return first.filter(within("first_transaction", start, end))


def first_transaction_dates(store: Store, start: DateLike, end: DateLike) -> DataFrame:
    """:func:`first_transactions` with the users' names.

    Grouped before the user table is joined: what is shuffled is one row per user and task.
    """
    named = first_transactions(store, start, end).join(store.users.select("id", "name"), "id")
    return named.select("first_transaction", "id", "name")


def referrals(store: Store) -> DataFrame:
    """Weekly influencer metrics, all of them."""
    return store.referrals


def run_query_file(
    spark: SparkSession, path: str, parameters: dict[str, object], tables: dict[str, DataFrame]
) -> DataFrame:
    """Run a query kept in a ``.sql`` file.

    ``:name`` markers take ``parameters`` as typed values, never as text put into the query, and
    ``{name}`` markers take ``tables``.
    """
    return spark.sql(Path(path).read_text(), args=parameters, **tables)


def campaign_stage(campaigns: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Staged campaign rows within the dates, newest first.

    Rows of one date follow their hash, so that the sort can cut a date with very many rows into several tasks.
    """
    rows = campaigns.filter(F.col("date").between(F.lit(as_date(start)), F.lit(as_date(end))))
    return rows.orderBy(F.desc("date"), F.xxhash64(*rows.columns))
