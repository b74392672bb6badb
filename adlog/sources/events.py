"""Order-conversion events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog import schemas
from adlog.channels import BING, SEARCH, Channel
from adlog.functions.dates import DateLike, as_date
from adlog.functions.scalars import whole_number

# The event and the medium that mark an order brought in by a paid click.
ORDER_EVENT = "Completed Order"
PAID_MEDIUM = "cpc"
# Column that loaded events are laid out by, besides their name.
EVENT_DAY = "event_day"


def flatten_events(events: DataFrame) -> DataFrame:
    """``event`` and its ``properties`` side by side; ``$city`` becomes ``x_city``."""
    properties = [
        F.col(f"properties.`{name}`").alias("x_" + name[1:] if name.startswith("$") else name)
        for name in events.schema["properties"].dataType.names
    ]
    return events.select("event", *properties)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event export, one JSON object per line, as a flat table."""
    return flatten_events(spark.read.schema(schemas.EVENT).json(path))


def epoch_seconds(day: dt.date) -> int:
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.UTC).timestamp())


def order_conversions(events: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Paid-click orders of all engines whose time lies within the dates, with a numeric ``app_user_id``.

    ``time`` is in seconds since 1970, so the window is a plain range that reaches the scan. A table that was loaded with
    :data:`EVENT_DAY` is read in the folders of those days only.
    """
    first = epoch_seconds(as_date(start))
    after = epoch_seconds(as_date(end) + dt.timedelta(days=1))
    if EVENT_DAY in events.columns:
        events = events.filter(F.col(EVENT_DAY).between(F.lit(as_date(start)), F.lit(as_date(end)))).drop(EVENT_DAY)
    return (
        events.filter(F.col("event") == ORDER_EVENT)
        .filter(F.col("latest_ad_utm_medium") == PAID_MEDIUM)
        .filter((F.col("time") >= first) & (F.col("time") < after))
        .withColumn("id", whole_number(F.col("id")))
        .withColumnRenamed("id", "app_user_id")
    )


def channel_conversions(events: DataFrame, channel: Channel, start: DateLike, end: DateLike) -> DataFrame:
    """:func:`order_conversions` of one engine."""
    return order_conversions(events, start, end).filter(F.col("latest_ad_utm_source") == channel.event_source)


def conversions_by_channel(events: DataFrame, start: DateLike, end: DateLike) -> dict[str, DataFrame]:
    """:func:`channel_conversions` of every engine, by channel name."""
    return {channel.name: channel_conversions(events, channel, start, end) for channel in (SEARCH, BING)}
