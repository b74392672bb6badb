"""Ad-spend reports: search keywords, search campaigns, and the second engine's keyword file.

Each ``clean_*`` function is a projection and a date filter. It needs no shuffle and works the same on a
batch and on a streaming DataFrame. ``read_*`` adds the file format.
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog import schemas
from adlog.channels import BING, SEARCH
from adlog.functions import scalars
from adlog.functions.dates import DateLike
from adlog.operators.filters import date_window

Columns = dict[str, tuple[str, T.DataType]]

# Date pattern and first header of the second engine's file.
BING_DATE_PATTERN = "M/d/yyyy"
BING_FIRST_HEADER = "gregoriandate"
# Whether a line may begin with that header; a line of data is told by its first character.
BING_HEADER_START = "^[^A-Za-z0-9,]*[gG]"


def header_key(header: str) -> str:
    """An export header without case, blanks and punctuation."""
    return re.sub(r"[^a-z0-9]", "", header.lower())


def rename_headers(report: DataFrame, columns: Columns) -> DataFrame:
    """Rename export headers to column names; headers ``columns`` does not list keep their key."""
    keys = [header_key(header) for header in report.columns]
    return report.toDF(*[columns[key][0] if key in columns else key for key in keys])


def typed(report: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column in its type; text that does not parse is NULL. Numbers may have thousands separators or be per cent."""
    value = F.col(name)
    if isinstance(report.schema[name].dataType, T.StringType) and isinstance(kind, T.NumericType):
        value = scalars.export_number(value)
        if isinstance(kind, T.LongType):
            return scalars.whole_number(value)
    return value.try_cast(kind)


def cast_columns(report: DataFrame, columns: Columns) -> DataFrame:
    """Give every known column its type."""
    present = set(report.columns)
    return report.withColumns({name: typed(report, name, kind) for name, kind in columns.values() if name in present})


def unparsed_cells(raw: DataFrame, columns: Columns) -> DataFrame:
    """How many cells of each column of an export hold text that became NULL: one row, one column for each."""
    report = rename_headers(raw, columns)
    present = set(report.columns)
    lost = {
        name: (F.trim(F.col(name).cast("string")) != "") & typed(report, name, kind).isNull()
        for name, kind in columns.values()
        if name in present
    }
    return report.agg(*[F.count_if(bad).alias(name) for name, bad in lost.items()])


def clean_search_keyword_report(raw: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Search keyword report with clean names, types, keywords and devices, within the dates."""
    report = cast_columns(rename_headers(raw, schemas.SEARCH_KEYWORD_COLUMNS), schemas.SEARCH_KEYWORD_COLUMNS)
    return date_window(report, start, end).withColumns(
        {
            "keyword": SEARCH.keyword(F.col("keyword")),
            "device": scalars.relabel(F.col("device"), SEARCH.devices),
        }
    )


def clean_campaign_report(raw: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Campaign report with clean names, types and devices, within the dates."""
    report = cast_columns(rename_headers(raw, schemas.CAMPAIGN_COLUMNS), schemas.CAMPAIGN_COLUMNS)
    return date_window(report, start, end).withColumn(
        "device", scalars.relabel(F.col("device"), SEARCH.devices)
    )


def clean_bing_keyword_report(raw: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Second engine's keyword report; dates may still be ``M/d/yyyy`` text."""
    report = rename_headers(raw, schemas.BING_KEYWORD_COLUMNS)
    if isinstance(report.schema["date"].dataType, T.StringType):
        report = report.withColumn("date", F.try_to_date(F.col("date"), BING_DATE_PATTERN))
    report = cast_columns(report, schemas.BING_KEYWORD_COLUMNS)
    return date_window(report, start, end).withColumns(
        {
            "day_of_week": scalars.day_of_week(F.col("date")),
            "keyword": BING.keyword(F.col("keyword")),
            "device": scalars.relabel(F.col("device"), BING.devices),
        }
    )


def bing_schema(headers: list[str]) -> T.StructType:
    return T.StructType([T.StructField(header_key(header), T.StringType()) for header in headers])


def bing_data_rows(rows: DataFrame) -> DataFrame:
    """Rows of the second engine's file whose first field is a date.

    That drops the preamble, the header and the copyright footer without counting lines, so a file may be split anywhere
    and files may be read together.
    """
    return rows.filter(F.try_to_date(F.col(rows.columns[0]), BING_DATE_PATTERN).isNotNull())


def read_csv_report(spark: SparkSession, path: str) -> DataFrame:
    """A report export with a header line, every field as text.

    All files below ``path`` must have the same columns in the same order: Spark compares the header of each file that it
    reads with that of the first, and fails rather than read a file into the wrong columns.
    """
    return spark.read.csv(path, header=True, escape='"', enforceSchema=False)


def read_search_keyword_report(spark: SparkSession, path: str, start: DateLike, end: DateLike) -> DataFrame:
    return clean_search_keyword_report(read_csv_report(spark, path), start, end)


def read_campaign_report(spark: SparkSession, path: str, start: DateLike, end: DateLike) -> DataFrame:
    return clean_campaign_report(read_csv_report(spark, path), start, end)


def bing_headers(spark: SparkSession, path: str) -> list[str]:
    """The header fields of the second engine's file or files; an error if they differ or there are none."""
    is_header = F.regexp_replace(F.lower("value"), "[^a-z0-9,]", "").startswith(BING_FIRST_HEADER)
    is_header = F.when(F.col("value").rlike(BING_HEADER_START), is_header).otherwise(False)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).filter(is_header)
    by_line = lines.groupBy("value").agg(F.min("file").alias("file")).limit(100).collect()
    layouts: dict[tuple[str, ...], str] = {}
    fields: list[str] = []
    for line, file in sorted(map(tuple, by_line)):
        fields = next(csv.reader([line]))
        layouts.setdefault(tuple(map(header_key, fields)), file)
    if not layouts:
        raise ValueError(f"no header line with the field 'Gregorian date' in {path}")
    if len(layouts) > 1:
        raise ValueError(f"files with different columns: {', '.join(sorted(layouts.values()))}")
    return fields


def read_bing_keyword_report(spark: SparkSession, path: str, start: DateLike, end: DateLike) -> DataFrame:
    """The second engine's file or files; the column order is taken from the header line, which all files share."""
    rows = spark.read.schema(bing_schema(bing_headers(spark, path))).csv(path, escape='"', enforceSchema=True)
    return clean_bing_keyword_report(bing_data_rows(rows), start, end)
