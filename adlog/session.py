"""Session settings the engine is designed for."""

from __future__ import annotations

# Every one is a runtime SQL setting, so it can also be put on an existing session.
SETTINGS = {
    # Re-plan at run time: measured sizes decide on broadcasts, small partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a partition that one hot key makes too large, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Drop rows of the large side of a join early when the other side is small and selective.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark):
    """Put :data:`SETTINGS` on a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
