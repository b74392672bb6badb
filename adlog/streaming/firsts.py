"""The first conversion of each user, and what first brought them, kept up to date from a stream of events.

The state is one row for each key, its earliest row so far, in Spark's own state store. Each run takes the new files, changes the state, and
puts out the keys that are new or have an earlier row now: a late row corrects what was put out before. State does not
expire, as a first order never stops being the first, so there is no watermark that could drop a late row.

The rows that come out are written to a folder for each micro-batch, which a repeated batch replaces. The newest row of a key is its
earliest one, so reading takes the earliest again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog.channels import Channel
from adlog.functions.dates import DateLike
from adlog.operators.attribution import ACQUISITION_COLUMNS
from adlog.operators.filters import monetary_rows
from adlog.sources.events import channel_conversions


def earliest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row for each ``key``, NULL being one: the first by ``order``, NULLs last, then by all other columns.

    A minimum of structs: it runs on tables and on streams, adds up in the tasks before the shuffle, and merges with itself.
    """
    ranked = [*order, *sorted(set(rows.columns) - {key, *order})]
    fields = [cell for name in ranked for cell in (F.col(name).isNull().alias(f"__no_{name}"), F.col(name))]
    found = rows.groupBy(key).agg(F.min(F.struct(*fields)).alias("first"))
    return found.select(*[F.col(key) if name == key else F.col(f"first.{name}").alias(name) for name in rows.columns])


def first_conversions(events: DataFrame, channel: Channel, start: DateLike, end: DateLike) -> DataFrame:
    """Each user's first conversion, of a table or a stream of flat events."""
    return earliest(channel_conversions(events, channel, start, end), "app_user_id", ["time", "orderId"])


def first_clicks(elog: DataFrame) -> DataFrame:
    """What first brought each user, of a table or a stream of event-log rows with their week."""
    rows = monetary_rows(elog).select("user_id", "week", *ACQUISITION_COLUMNS)
    return earliest(rows, "user_id", ["week", *ACQUISITION_COLUMNS])


def keep_up(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Take what is new in a stream of :func:`first_conversions` or :func:`first_clicks`, and return when it is in ``table``."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch={batch}")

    (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def kept(spark: SparkSession, table: str, key: str, order: Sequence[str]) -> DataFrame:
    """What :func:`keep_up` has put into ``table``: the newest row of each key."""
    return earliest(spark.read.parquet(table).drop("batch"), key, order)
