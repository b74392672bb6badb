"""Row-level expressions: Column in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# One-letter match types in the ad tags and their report names.
MATCH_TYPES = {
    "b": "Broad",
    "e": "Exact",
    "p": "Phrase",
}


def relabel(value: Column, names: Mapping[str, str]) -> Column:
    """Map whole values by ``names``; values it does not list pass through."""
    chain = None
    for old, new in names.items():
        match = value == old
        chain = F.when(match, new) if chain is None else chain.when(match, new)
    return chain.otherwise(value)


def normalize_keyword_bing(keyword: Column) -> Column:
    """Lower case, without the ``+`` of modified broad match."""
    return F.replace(F.lower(keyword), F.lit("+"), F.lit(""))


def normalize_keyword(keyword: Column) -> Column:
    """As :func:`normalize_keyword_bing`, then each pair of spaces becomes one, in a single pass."""
    return F.replace(normalize_keyword_bing(keyword), F.lit("  "), F.lit(" "))


def normalize_match_type(code: Column) -> Column:
    """``b``, ``e``, ``p`` to their names; a value that is already a name stays as it is."""
    return relabel(code, MATCH_TYPES)


def monday_week(day: Column) -> Column:
    """Monday of the Sunday-started week: Monday to Saturday go back to Monday, Sunday goes one day on.

    Date arithmetic only, so the session time zone plays no part.
    """
    return F.next_day(F.date_sub(day, 6), "MON")


def day_of_week(day: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(day, "EEEE")


def month_bucket(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def whole_number(text: Column) -> Column:
    """Text or a number as a whole number, fractions cut off: ``123``, ``123.0`` and ``1E5`` are numbers; else NULL."""
    return F.trim(text.cast("string")).try_cast("decimal(38,6)").try_cast("long")


def export_number(text: Column) -> Column:
    """The text of an export's number without thousands separators; per cent as a fraction. Other text stays as it is."""
    plain = F.replace(F.trim(text), F.lit(","), F.lit(""))
    share = (F.rtrim(F.replace(plain, F.lit("%"), F.lit(""))).try_cast("decimal(30,10)") / 100).cast("string")
    return F.when(plain.endswith("%"), share).otherwise(plain)


def keyword_id_from_tag(tag: Column) -> Column:
    """``kwd-123`` to 123; NULL where no number is left."""
    return whole_number(F.replace(tag, F.lit("kwd-"), F.lit("")))


def capped_share(share: Column) -> Column:
    """A share above one is reported as one; NULL stays NULL."""
    return F.when(share >= 1.0, F.lit(1.0)).otherwise(share)


def cohort_label(number: Column) -> Column:
    return F.concat(F.lit("cohort_"), number.cast("string"))
