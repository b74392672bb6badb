"""Report files with what was not understood kept beside the report.

A file is read once, as lines. Each line becomes a row of the clean report, or of none, and carries the reasons for which something
in it was not understood. All of it goes to one staged table, from which the report and the rejected lines are read. A cell that
is no value of its column is NULL in the report, as ever, and its line is among the rejected ones with its file; a line
with too few or too many fields is rejected and in no report. ``--`` and empty fields are missing values, which is no fault.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog import schemas
from adlog.functions.dates import DateLike
from adlog.sources.reports import (
    BING_DATE_PATTERN,
    BING_FIRST_HEADER,
    Columns,
    bing_headers,
    clean_bing_keyword_report,
    clean_campaign_report,
    clean_search_keyword_report,
    header_key,
    read_csv_report,
    typed,
)
from adlog.sources.sinks import materialize

# Fixed value: what exports write where there is no value.
MISSING = "--"
LINE, FILE, BLOCK, REASONS, WRONG = "line", "file", "block_start", "reasons", "__wrong"
WRONG_FIELDS = "number of fields"


@dataclass(frozen=True)
class Checked:
    """``report`` is the clean report; ``rejected`` has ``file, block_start, line, reasons`` and the line's fields as text.

    ``block_start`` is the first byte of the part of the file that a task read, within which the line is.
    """

    report: DataFrame
    rejected: DataFrame


def _fault(report: DataFrame, name: str, kind: T.DataType, date_pattern: str | None) -> Column:
    """The reason, ``column: text``, for which a cell became NULL, or NULL."""
    text = F.trim(F.col(name))
    value = F.try_to_date(F.col(name), date_pattern) if date_pattern and name == "date" else typed(report, name, kind)
    return F.when((text != "") & (text != MISSING) & value.isNull(), F.concat(F.lit(f"{name}: "), F.col(name)))


def _checked(
    spark: SparkSession,
    path: str,
    headers: list[str],
    columns: Columns,
    clean: Callable[[DataFrame, DateLike | None, DateLike | None], DataFrame],
    start: DateLike | None,
    end: DateLike | None,
    furniture: Callable[[Column, Column], Column],
    date_pattern: str | None = None,
) -> Checked:
    names = [columns[key][0] if (key := header_key(header)) in columns else key for header in headers]
    fields = ", ".join(f"`{name}` STRING" for name in names)
    lines = spark.read.text(path).select(
        F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": WRONG, "escape": '"'}
    split = lines.withColumn("cells", F.from_csv(F.col(LINE), f"{fields}, {WRONG} STRING", options))
    first = F.coalesce(F.col(f"cells.`{names[0]}`"), F.lit(""))
    split = split.filter(F.trim(F.col(LINE)) != "").filter(~furniture(first, F.col(f"cells.{WRONG}").isNotNull()))
    raw = split.select(LINE, FILE, BLOCK, F.col(f"cells.{WRONG}").isNotNull().alias(WRONG), *[f"cells.`{name}`" for name in names])
    faults = [_fault(raw, name, kind, date_pattern) for name, kind in columns.values() if name in names]
    reasons = F.when(F.col(WRONG), F.array(F.lit(WRONG_FIELDS))).otherwise(F.array_compact(F.array(*faults)))
    judged = raw.withColumn(REASONS, reasons).withColumn(LINE, F.when(F.size(REASONS) > 0, F.col(LINE)))
    staged = materialize(judged, "checked-report")
    rejected = staged.filter(F.col(LINE).isNotNull()).select(FILE, BLOCK, LINE, REASONS, *[F.col(f"`{name}`") for name in names])
    return Checked(clean(staged.filter(~F.col(WRONG)).select(*[F.col(f"`{name}`") for name in names]), start, end), rejected)


def _cleaned(clean, columns: Columns):
    """``clean`` takes exports by their headers: give the columns those again."""
    headers = {name: key for key, (name, _) in columns.items()}
    return lambda rows, start, end: clean(rows.toDF(*[headers.get(name, name) for name in rows.columns]), start, end)


def _with_header(spark, path, columns: Columns, clean, start, end) -> Checked:
    headers = read_csv_report(spark, path).columns
    is_header = lambda first, wrong: (first == F.lit(headers[0])) & ~wrong
    return _checked(spark, path, headers, columns, _cleaned(clean, columns), start, end, is_header)


def checked_search_keyword_report(spark: SparkSession, path: str, start: DateLike | None = None, end: DateLike | None = None) -> Checked:
    """The search keyword report of ``path``, a file or a folder of files with one header line each, and what it lost."""
    return _with_header(spark, path, schemas.SEARCH_KEYWORD_COLUMNS, clean_search_keyword_report, start, end)


def checked_campaign_report(spark: SparkSession, path: str, start: DateLike | None = None, end: DateLike | None = None) -> Checked:
    """The campaign report of ``path`` and what it lost."""
    return _with_header(spark, path, schemas.CAMPAIGN_COLUMNS, clean_campaign_report, start, end)


def checked_bing_keyword_report(spark: SparkSession, path: str, start: DateLike | None = None, end: DateLike | None = None) -> Checked:
    """The second engine's keyword report of ``path`` and what it lost.

    Preamble and footer are lines without the report's fields and without a date in front; a line with a date in front and too
    few or too many fields is rejected.
    """
    headers, columns = bing_headers(spark, path), schemas.BING_KEYWORD_COLUMNS

    def furniture(first: Column, wrong: Column) -> Column:
        is_header = F.regexp_replace(F.lower(first), "[^a-z0-9]", "") == BING_FIRST_HEADER
        return is_header | (wrong & F.try_to_date(first, BING_DATE_PATTERN).isNull())

    clean = _cleaned(clean_bing_keyword_report, columns)
    return _checked(spark, path, headers, columns, clean, start, end, furniture, date_pattern=BING_DATE_PATTERN)
