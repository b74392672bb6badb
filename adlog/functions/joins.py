"""Join helpers for skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__null_spread"


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join on an integer ``key`` that is NULL on a large part of the left rows.

    Rows with a NULL key never match, yet a plain shuffle sends all of them to one task. Here they carry a
    second key part, a hash of ``spread_by``, that spreads them over all tasks, however many there are; every other row has 0
    there. ``spread_by`` names a few narrow columns of the left side that tell its rows apart: only these are read beyond what
    the caller asks for. The hash depends on the row alone, so a retried task sends each row to the same place.
    """
    salt = F.xxhash64(*[F.col(f"`{name}`") for name in spread_by])
    salted = left.withColumn(_SPREAD, F.when(F.col(key).isNull(), salt).otherwise(F.lit(0)).cast("long"))
    # pmod(key, 1) is 0 for every key; a literal would be folded away as a join key.
    matched = right.withColumn(_SPREAD, F.pmod(F.col(key).cast("long"), F.lit(1)).cast("long"))
    return salted.join(matched, [key, _SPREAD], "left").drop(_SPREAD)
