"""Summaries of several grains from one pass over the event log.

Sums add up from a fine grain to a coarser one; counts of different users don't. Here a set of users is a bitmap, and
bitmaps do: the users of a month are the union of those of its weeks. Users get numbers in the order of where they occur, so that the users of
one keyword and campaign are neighbours and share few bitmaps of 32,768 numbers each. A bitmap holds only the 64-bit words that are not 0:
one user of a cell takes 16 bytes, all of a block 8 KB. Words are merged by ``bit_or``, which a hash aggregate holds as a number;
Spark's own bitmap aggregates take 4 KB for any set and sort their rows.

The log is read once, for :func:`cells`: sums and bitmaps at the finest grain, which are staged. Every grain is then a union and
a sum of cells, all of them in one pass of grouping sets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlog.channels import SEARCH, Channel
from adlog.functions.aggregates import CENTS, cents, exact_parts, exact_total, ratio, zero_if_null
from adlog.operators.kpis import kpi_figures
from adlog.sources.sinks import materialize

LabelledStage = Callable[[DataFrame, str], DataFrame]
USERS, BLOCK, NUMBER, GRAIN = "users", "user_block", "user_number", "grain"
WORD, BITS = "user_word", "user_bits"
WORD_SHIFT, BLOCK_SHIFT = 6, 15  # numbers of a word, and of a block, as powers of two
Grains = Mapping[str, Sequence[str]]


def additive_parts(elog: DataFrame, channel: Channel = SEARCH) -> dict[str, Column]:
    """What a summary adds up, as whole numbers (whole cents are held in doubles)."""
    position = exact_parts(F.col("average_position") * F.col("impressions"), 4)
    parts = {
        "cost_cents": cents(F.col("cost")),
        "earned_cents": cents(F.col("money_in_the_bank_paid_to_us")),
        "impressions": F.col("impressions"),
        "clicks": F.col("clicks"),
        "position_whole": position[0],
        "position_decimals": position[1],
        "position_weight": F.when(F.col("average_position").isNotNull(), F.col("impressions")),
    }
    if channel.has_impression_share:
        available = exact_parts(ratio(F.col("impressions"), F.col("est_search_impression_share")), 6)
        parts |= {"available_whole": available[0], "available_decimals": available[1]}
    if "new_referred_users" in elog.columns:
        parts["referred_users"] = F.col("new_referred_users")
    if "referred_users_transaction_amount" in elog.columns:
        parts["referred_cents"] = cents(F.col("referred_users_transaction_amount"))
    return parts


def user_numbers(per_user: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``user_id, user_number``: users numbered in the order of their smallest keys, each task from a number of its own.

    Stage the result before use: a number holds for good once it is written.
    """
    first = per_user.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.min(F.struct(*keys)).alias("first"))
    return first.orderBy("first", "user_id").select("user_id", F.monotonically_increasing_id().alias(NUMBER))


def cells(
    elog: DataFrame,
    keys: Sequence[str],
    parts: Mapping[str, Column] | None = None,
    stage: LabelledStage = materialize,
    numbers: DataFrame | None = None,
) -> DataFrame:
    """``keys``, a block of users and their bitmap (NULL for rows without a user), and the sums of ``parts``, staged.

    A bitmap is an array of words, each with its number and its bits.

    The log is read once. Cells of several logs can be put together if they share their ``numbers``, which must then hold all
    users of each; by default they are made here.
    """
    parts = parts or {}
    sums = [F.sum(value).alias(name) for name, value in parts.items()]
    again = [F.sum(name).alias(name) for name in parts]
    count = [] if parts else [F.count(F.lit(1)).alias("n_rows")]
    per_user = stage(elog.groupBy(*keys, "user_id").agg(*sums, *count), "per-user")
    if numbers is None:
        numbers = stage(user_numbers(per_user, keys), "user-numbers")
    # Rows without a user do not go through the join: there may be very many of them.
    known = per_user.filter(F.col("user_id").isNotNull()).join(numbers, "user_id")
    number = F.col(NUMBER)
    bit = F.expr(f"shiftleft(1L, cast({NUMBER} & {(1 << WORD_SHIFT) - 1} as int))")
    placed = known.select(*keys, F.shiftright(number, BLOCK_SHIFT).alias(BLOCK), F.shiftright(number, WORD_SHIFT).alias(WORD), bit.alias(BITS), *parts)
    # A cell has at most one row for each user of its block, so one shuffle by cells serves both steps and no partition is hot.
    words = placed.repartition(*keys, BLOCK).groupBy(*keys, BLOCK, WORD).agg(F.bit_or(BITS).alias(BITS), *again)
    with_users = words.groupBy(*keys, BLOCK).agg(F.collect_list(F.struct(WORD, BITS)).alias(USERS), *again)
    nobody = per_user.filter(F.col("user_id").isNull())
    nobody = nobody.select(*keys, F.lit(None).cast("long").alias(BLOCK), F.lit(None).cast(with_users.schema[USERS].dataType).alias(USERS), *parts)
    return stage(with_users.unionByName(nobody), "cells")


def roll_up(found: DataFrame, grains: Grains) -> DataFrame:
    """``grain``, its keys (NULL where a grain lacks one), the sums of all parts and ``num_acquisitions``, for all grains at once.

    Every cell becomes a row of its sums, whose word is NULL, and one row for each word of users. Grouping sets bring the rows of
    each grain and word together, then the bits of the words are counted and added.
    """
    every = list(dict.fromkeys(key for keys in grains.values() for key in keys))
    parts = [name for name in found.columns if name not in (*every, BLOCK, USERS)]
    parts = [name for name in parts if name in _numbers(found)]
    columns = [*every, WORD]
    sums = [F.sum(name).alias(name) for name in parts]
    none = F.lit(None).cast("long")
    own = F.array(F.struct(none.alias(WORD), none.alias(BITS)))
    words = F.concat(own, F.coalesce(F.col(USERS), F.array().cast(found.schema[USERS].dataType)))
    listed = found.select(*every, *parts, F.inline(words).alias(WORD, BITS))
    listed = listed.select(*every, WORD, BITS, *[F.when(F.col(WORD).isNull(), F.col(name)).alias(name) for name in parts])
    sets = [[F.col(key) for key in (*keys, WORD)] for keys in grains.values()]
    merged = F.bit_or(BITS).alias(BITS)
    grouped = listed.groupingSets(sets, *[F.col(name) for name in columns]).agg(F.grouping_id().alias("__grain"), merged, *sums)
    # bits of grouping_id: 1 for each column that is not of the grain
    names = {sum(1 << i for i, name in enumerate(reversed(columns)) if name not in (*keys, WORD)): grain for grain, keys in grains.items()}
    label = F.coalesce(*[F.when(F.col("__grain") == number, F.lit(grain)) for number, grain in names.items()])
    counted = grouped.select(label.alias(GRAIN), *every, *parts, F.bit_count(BITS).cast("long").alias("num_acquisitions"))
    return counted.groupBy(GRAIN, *every).agg(*sums, zero_if_null(F.sum("num_acquisitions")).alias("num_acquisitions"))


def _numbers(found: DataFrame) -> set[str]:
    return {name for name, kind in found.dtypes if kind in ("bigint", "double")}


def acquisitions_rollup(elog: DataFrame, grains: Grains, stage: LabelledStage = materialize) -> DataFrame:
    """``grain``, its keys and ``num_acquisitions``, the exact number of different users, for each grain."""
    keys = list(dict.fromkeys(key for keys in grains.values() for key in keys))
    return roll_up(cells(elog, keys, stage=stage), grains)


def kpi_rollup(elog: DataFrame, grains: Grains, channel: Channel = SEARCH, stage: LabelledStage = materialize) -> DataFrame:
    """The KPI summary of every grain, as :func:`adlog.operators.kpis.summarize_elog` makes it, with the grain's name beside."""
    keys = list(dict.fromkeys(key for keys in grains.values() for key in keys))
    found = roll_up(cells(elog, keys, additive_parts(elog, channel), stage), grains)

    def total(name: str, kind: str = "double") -> Column:
        return zero_if_null(F.col(name)) if name in found.columns else F.lit(None).cast(kind)

    totals = {
        "cost": total("cost_cents") / CENTS,
        "average_position": ratio(exact_total(F.col("position_whole"), F.col("position_decimals"), 4), F.col("position_weight")),
        "impressions": total("impressions"),
        "clicks": total("clicks"),
        "num_acquisitions": F.col("num_acquisitions"),
        "earnings": total("earned_cents") / CENTS,
        "referred_users": total("referred_users", "long"),
        "referred_earnings": total("referred_cents") / CENTS,
    }
    if channel.has_impression_share:
        available = exact_total(F.col("available_whole"), F.col("available_decimals"), 6)
        totals["estimated_available_impressions"] = F.coalesce(available, F.lit(0.0))
    by = [GRAIN, *keys]
    return kpi_figures(found.select(*by, *[value.alias(name) for name, value in totals.items()]), *by, channel=channel)
