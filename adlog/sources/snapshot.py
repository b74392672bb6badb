"""Each user's first order as a kept table, so that a run reads new orders only.

The first order is a minimum, and minima merge: the table holds a row for each user and batch, and reading it takes the
minimum again. It is bucketed by user, so that reading, and joining it with other tables of those buckets, shuffles nothing.
Adding a batch appends its minima and reads no old row. A batch that is added twice, whole or in part, changes nothing, nor does the order
of batches: an earlier order may come late. Now and then the rows of all batches are put together in a new folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog.sources.versions import Versions

KEY = "id"
VALUE = "first_transaction"


def bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> str:
    """The name of a table in ``path`` that is bucketed and sorted by ``key``; made if the session does not know it.

    The folder is all there is to keep: another session gives the table its name again.
    """
    name = f"adlog_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return name


class FirstOrders:
    """The kept table below ``root``. ``buckets`` holds from the first batch on: about the table's size / 128 MB."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, compact_after: int = 16):
        self.spark, self.versions = spark, Versions(spark, root)
        self.buckets, self.compact_after = buckets, compact_after

    def _table(self, now: dict) -> str:
        return bucketed(self.spark, now["folder"], T.StructType.fromJson(now["schema"]), KEY, now["buckets"])

    def batch(self, transactions: DataFrame) -> DataFrame:
        """``id, first_transaction`` of a batch of transactions, complete or not, one row for each user."""
        known = transactions.filter(F.col("user_id").isNotNull() & F.col("created_at").isNotNull())
        return known.groupBy(F.col("user_id").alias(KEY)).agg(F.min("created_at").alias(VALUE))

    def add(self, transactions: DataFrame) -> None:
        """Merge a batch of transactions into the table."""
        new = self.batch(transactions)
        number, now = self.versions.current()
        if not now:
            now = {"folder": self.versions.new_folder("first-orders"), "schema": new.schema.jsonValue(), "buckets": self.buckets, "parts": 0}
        elif now["parts"] >= self.compact_after:
            number, now = self._compacted(number, now)
        new.repartition(now["buckets"], KEY).write.insertInto(self._table(now))
        self.versions.publish(now | {"parts": now["parts"] + 1}, number)

    def _compacted(self, number: int, now: dict) -> tuple[int, dict]:
        after = now | {"folder": self.versions.new_folder("first-orders"), "parts": 1}
        self.rows().write.insertInto(self._table(after))
        return self.versions.publish(after, number), after

    def rows(self) -> DataFrame:
        """``id, first_transaction`` of every user so far; nothing is shuffled."""
        _, now = self.versions.current()
        if not now:
            raise ValueError(f"no orders in {self.versions.root} yet")
        return self.spark.table(self._table(now)).groupBy(KEY).agg(F.min(VALUE).alias(VALUE))
