"""Aggregate expressions.

Sums of nothing are 0 and a division by zero is NULL, whatever the session's ANSI mode.

Money is ``DECIMAL(18,2)`` in every table, but Spark adds decimals of that width row by row through
``BigDecimal``, several times slower than doubles. Sums of money therefore add *whole cents held in doubles*, which is exact
up to 2**53 cents (9e13 of the currency), and sums of other numbers add whole parts and decimals as integers
(:func:`exact_sum`). So no result depends on the order in which tasks finish or are retried, and the hash aggregate keeps
primitive buffers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100.0


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def cents(amount: Column) -> Column:
    """A money amount as a whole number of cents in a double."""
    return F.rint(amount.cast("double") * CENTS)


def sum_cents(amount: Column) -> Column:
    """Exact sum of a money column, in cents; 0 when there is nothing to add."""
    return F.coalesce(F.sum(cents(amount)), F.lit(0.0))


def sum_money(amount: Column) -> Column:
    """Exact sum of a money column; 0 when there is nothing to add."""
    return sum_cents(amount) / CENTS


def sum_count(value: Column) -> Column:
    """Sum of an integer column; 0 when there is nothing to add."""
    return zero_if_null(F.sum(value))


def exact_sum(value: Column, digits: int) -> Column:
    """Sum of a number column, each row taken to so many decimals; NULL when there is nothing to add.

    Whole parts and decimals are added apart, as 64-bit integers: exact up to 9e18 in total and, for six digits, 9e12 rows of a
    group. Beyond that Spark fails rather than lose a digit.
    """
    whole, decimals = exact_parts(value, digits)
    return exact_total(F.sum(whole), F.sum(decimals), digits)


def exact_parts(value: Column, digits: int) -> tuple[Column, Column]:
    """Whole part and decimals of a number as integers; sums of each make :func:`exact_total`, in one step or in several."""
    whole = F.floor(value)
    return whole.cast("long"), F.rint((value - whole) * 10.0**digits).cast("long")


def exact_total(whole: Column, decimals: Column, digits: int) -> Column:
    parts = whole.cast("decimal(20,0)"), decimals.cast("decimal(20,0)")
    return (parts[0] + parts[1] / F.lit(10**digits).cast("decimal(10,0)")).cast("double")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of ``value`` weighted by ``weight``; rows without a value do not count.

    Products are taken to four decimals.
    """
    return ratio(exact_sum(value * weight, 4), F.sum(F.when(value.isNotNull(), weight)))


def sum_available(impressions: Column, share: Column) -> Column:
    """Sum of impressions / share over the rows, each to six decimals; a share of 0 or NULL is skipped."""
    return F.coalesce(exact_sum(ratio(impressions, share), 6), F.lit(0.0))
