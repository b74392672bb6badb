"""Load each report or event file once, as it arrives.

The cleaning of every source is a projection, so it runs on a stream of files unchanged. Every row is loaded, whatever
its date: the checkpoint marks whole files as in, so what a window left out could never be had later. Filter by date when
the table is read. A run
takes the files that are new since the last one (``availableNow``) and appends them to a Parquet table; the
checkpoint remembers which files are in, so a repeated or restarted run adds nothing twice. Later jobs read
the table and never go back to the exports. There is no state and no window, hence no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog import schemas
from adlog.sources.events import EVENT_DAY, flatten_events
from adlog.sources.reports import (
    bing_data_rows,
    bing_schema,
    clean_bing_keyword_report,
    clean_campaign_report,
    clean_search_keyword_report,
)

Clean = Callable[[DataFrame], DataFrame]


def stream_csv_reports(spark: SparkSession, folder: str, headers: list[str]) -> DataFrame:
    """Report exports in ``folder`` as a stream of text fields; every file has these headers in this order."""
    schema = T.StructType([T.StructField(header, T.StringType()) for header in headers])
    return spark.readStream.schema(schema).csv(folder, header=True, escape='"', enforceSchema=False)


def stream_search_keyword_reports(spark: SparkSession, folder: str, headers: list[str]) -> DataFrame:
    return clean_search_keyword_report(stream_csv_reports(spark, folder, headers))


def stream_campaign_reports(spark: SparkSession, folder: str, headers: list[str]) -> DataFrame:
    return clean_campaign_report(stream_csv_reports(spark, folder, headers))


def stream_bing_keyword_reports(spark: SparkSession, folder: str, headers: list[str]) -> DataFrame:
    rows = spark.readStream.schema(bing_schema(headers)).csv(folder, escape='"')
    return clean_bing_keyword_report(bing_data_rows(rows))


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Flat events with the day (UTC) of their time beside them."""
    rows = flatten_events(spark.readStream.schema(schemas.EVENT).json(folder))
    return rows.withColumn(EVENT_DAY, F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("time") / 86400).cast("int")))


def append_new(stream: DataFrame, table: str, checkpoint: str, *partition_by: str) -> None:
    """Append what is new in ``stream`` to the Parquet ``table`` and return when it is in.

    ``table`` and ``checkpoint`` are folders all executors share. Reports are best partitioned by ``date`` and
    events by ``event`` and ``event_day``: those are what the event logs filter on.
    """
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(table)
        .awaitTermination()
    )
