"""Cumulative series that are resumed instead of added up from the first week.

Kept are each key's totals by week, in a folder for each week, and the carry: each key's total over all weeks. New rows change some weeks,
the earliest of which is where the series has to be worked out again. What each key had before that week is the carry less
the totals from that week on, exactly, as sums are whole cents. So only those weeks and the carry are read, and only those weeks are
written; most runs bring the newest weeks alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog.functions.aggregates import CENTS
from adlog.operators.kpis import MARGIN
from adlog.operators.series import sum_by_week, unpivot_metrics
from adlog.sources.versions import Versions

SUMS = ["cost_cents", "earned_cents"]
#: Rows without a week come after all others.
NO_WEEK = "none"


class KeptSeries:
    """The series of ``keys`` below ``root``, fed with event-log rows."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ("keyword",)):
        self.spark, self.versions, self.keys = spark, Versions(spark, root), list(keys)

    def _read(self, schema: dict, paths: list[str]) -> DataFrame:
        kind = T.StructType.fromJson(schema)
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def weeks_from(self, now: dict, first: str) -> DataFrame:
        """The kept weeks from one on: all of the series that a refresh reads."""
        return self._read(now["schema"], [path for week, path in sorted(now["weeks"].items()) if week >= first])

    def _same_keys(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in self.keys])

    def _by_key(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in SUMS])

    def add(self, elog: DataFrame) -> list[str]:
        """Bring new rows of the log in; the weeks that were written."""
        number, now = self.versions.current()
        folder = self.versions.new_folder("series")
        sum_by_week(elog, *self.keys).write.parquet(f"{folder}/new")
        new = self.spark.read.parquet(f"{folder}/new")
        kind = new.schema["week"].dataType.simpleString()
        name = lambda: F.coalesce(F.col("week").cast("string"), F.lit(NO_WEEK))
        first = new.agg(F.min(name())).first()[0]
        if first is None:
            return []
        if not now:
            kept = T.StructType([*[new.schema[key] for key in self.keys], T.StructField("week", new.schema["week"].dataType), *[T.StructField(s, T.DoubleType()) for s in [*SUMS, "cum_cost_cents", "cum_earned_cents"]]])
            now = {"schema": kept.jsonValue(), "weeks": {}, "carry": None}
        old = self.weeks_from(now, first)
        totals = old.select(*self.keys, "week", *SUMS).unionByName(new)
        totals = totals.groupBy(*self.keys, "week").agg(*[F.sum(s).alias(s) for s in SUMS])
        if now["carry"]:  # as of the week before
            less = old.select(*self.keys, *[(-F.col(s)).alias(s) for s in SUMS])
            carry = self._by_key(self.spark.read.parquet(now["carry"]).unionByName(less))
            before = carry.select(*self.keys, F.lit(None).cast(kind).alias("week"), *SUMS, F.lit(True).alias("carried"))
            totals = before.unionByName(totals.withColumn("carried", F.lit(False)))
        else:
            totals = totals.withColumn("carried", F.lit(False))
        order = Window.partitionBy(*self.keys).orderBy(F.desc("carried"), F.asc_nulls_last("week"))
        running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = {f"cum_{s}": F.sum(s).over(running) for s in SUMS}
        series = totals.withColumns(sums).filter(~F.col("carried")).drop("carried")
        series.withColumn("part", name()).hint("rebalance", "part").write.partitionBy("part").parquet(f"{folder}/weeks")
        added = new.drop("week")
        carry = self.spark.read.parquet(now["carry"]).unionByName(added) if now["carry"] else added
        self._by_key(carry).write.parquet(f"{folder}/carry")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/weeks")
        found = [s.getPath().getName() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        written = sorted(part.split("=")[1] for part in found if part.startswith("part="))
        weeks = now["weeks"] | {week: f"{folder}/weeks/part={week}" for week in written}
        self.versions.publish(now | {"weeks": weeks, "carry": f"{folder}/carry"}, number)
        return written

    def rows(self, earning_only: bool = True, margin: float = MARGIN) -> DataFrame:
        """The series in long form, as :func:`adlog.operators.series.cumulative` makes it; of earning keys only, if asked.

        Which keys have earned anything is in the carry.
        """
        _, now = self.versions.current()
        if not now:
            raise ValueError(f"no series in {self.versions.root} yet")
        found = self.weeks_from(now, "")
        if earning_only:
            earning = self.spark.read.parquet(now["carry"]).filter(F.col("earned_cents") > 0).select(*self.keys)
            found = found.join(earning, self._same_keys(found, earning), "left_semi")
        wide = found.select(
            *self.keys,
            "week",
            (F.col("cost_cents") / CENTS).alias("cost"),
            (F.col("earned_cents") / CENTS * margin).alias("contribution"),
            (F.col("cum_cost_cents") / CENTS).alias("cum_cost"),
            (F.col("cum_earned_cents") / CENTS * margin).alias("cum_contribution"),
        ).withColumn("cum_ROI", F.col("cum_contribution") - F.col("cum_cost"))
        return unpivot_metrics(wide, [*self.keys, "week", "cost", "contribution"], ["cum_cost", "cum_contribution", "cum_ROI"])
