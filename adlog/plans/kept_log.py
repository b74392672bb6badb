"""An event log that is kept and refreshed, instead of built again from all history.

What a user did in the log carries the click that first brought them, so a new conversion, a late order or a new campaign name
changes all rows of a user, and of nobody else. State is therefore kept in buckets of users:

* ``conversions``: each user's first conversion, ``orders``: each user's first order; both merge with new rows by "the first";
* ``sold``: the items sold in the window, before anybody knows who brought the buyer; ``referrals``: the weekly metrics;
* ``acquired``: the new customers with their click, cleaned and named, and whether they have bought;
* ``log``: the finished rows of users.

A refresh puts the increment's own rows into these, works ``acquired`` out again for the users' buckets it touches, and compares it with
what was there. Buckets in which somebody's click has changed are written anew from ``sold`` and ``referrals``; in all other buckets
the increment's rows are appended. Spend rows need no user and are appended. Tables of the grain of users are small beside the
items, which are read only in buckets that are written anew.

Everything goes to new folders, and one manifest makes the refresh current (:mod:`adlog.sources.versions`). A refresh that
fails leaves the log as it was, and repeating a refresh that went through does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog.channels import SEARCH, Channel
from adlog.functions.dates import DateLike, within
from adlog.operators.attribution import (
    ACQUISITION_COLUMNS,
    add_week,
    attach_campaign_name,
    attach_keyword_name,
    attribute_referrals,
    clean_tags,
    date_transactions,
    drop_tracking_columns,
    event_log_union,
    name_lookup,
)
from adlog.sources.events import channel_conversions
from adlog.sources.store import Store, transactions_extract
from adlog.sources.versions import Versions

TAGS = [
    "latest_ad_device",
    "latest_ad_utm_campaign",
    "latest_ad_awkeyword",
    "latest_ad_awadgroupid",
    "latest_ad_awmatchtype",
]
BUCKET = "bucket"


@dataclass(frozen=True)
class Increment:
    """What has come in: clean spend rows, flat events, and rows of the store, whose transactions come with their items.

    ``campaigns`` are rows that name campaigns, ``keywords`` rows that name keyword ids, for the engine whose tags hold ids.
    """

    spend: DataFrame
    campaigns: DataFrame
    events: DataFrame
    store: Store
    keywords: DataFrame | None = None


@dataclass
class Refreshed:
    """The buckets of users that a refresh has written anew, and those it has appended to."""

    rewritten: list[int] = field(default_factory=list)
    appended: list[int] = field(default_factory=list)


def bucket_of(user: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(user).cast("long")), F.lit(buckets)).cast("int").alias(BUCKET)


def first_conversions(rows: DataFrame) -> DataFrame:
    """The first of each user's conversions, by time, order and tags; it merges with itself."""
    order = [F.asc_nulls_last(name) for name in ("time", "orderId", *TAGS)]
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("app_user_id").orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


class KeptLog:
    """The event log of one channel and window below ``root``.

    ``buckets`` holds from the first refresh on. ``parts`` is the number of folders of a bucket beyond which it is written anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        start: DateLike,
        end: DateLike,
        channel: Channel = SEARCH,
        buckets: int = 256,
        parts: int = 16,
    ):
        self.spark, self.versions = spark, Versions(spark, root)
        self.start, self.end, self.channel = start, end, channel
        self.buckets, self.parts = buckets, parts

    # Tables: {"schema": ..., "parts": {bucket: [folders]}} in the manifest.

    def _state(self) -> tuple[int, dict]:
        number, now = self.versions.current()
        window = {"start": str(self.start), "end": str(self.end), "channel": self.channel.name}
        if now and now["window"] != window:
            raise ValueError(f"{self.versions.root} is the log of {now['window']}")
        return number, now or {"window": window, "buckets": self.buckets, "batches": [], "tables": {}}

    def _read(self, now: dict, name: str, buckets: list[int] | None = None) -> DataFrame | None:
        """A table, or its rows in some buckets, which are all that is read; None before its first row."""
        table = now["tables"].get(name)
        if table is None:
            return None
        schema = T.StructType.fromJson(table["schema"])
        chosen = table["parts"] if buckets is None else {k: v for k, v in table["parts"].items() if int(k) in set(buckets)}
        paths = [path for folders in chosen.values() for path in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, now: dict, name: str, rows: DataFrame, bucket: Column, anew: list[int] | None = None) -> None:
        """Write rows to a new folder with a subfolder for each bucket, and name them in ``now``.

        The folders of buckets in ``anew`` are replaced, also by nothing; those of others are added to. Large buckets are
        written by several tasks, small ones share a task.
        """
        folder = self.versions.new_folder(name)
        placed = rows.select("*", bucket).hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).parquet(folder)
        table = now["tables"].setdefault(name, {"schema": rows.schema.jsonValue(), "parts": {}})
        for k in anew or []:
            table["parts"].pop(str(k), None)
        for k in self._written(folder):
            table["parts"].setdefault(str(k), []).append(f"{folder}/{BUCKET}={k}")

    def _written(self, folder: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}="))

    def _buckets_in(self, now: dict, rows: DataFrame, user: str) -> list[int]:
        """The buckets that rows fall in: as many numbers as there are buckets at most."""
        return sorted(row[0] for row in rows.select(bucket_of(user, now["buckets"])).distinct().collect())

    def _merge(self, now: dict, name: str, new: DataFrame, user: str, merge: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Merge new rows, one for each user, into a table with a row for each user; the buckets that were touched.

        The new rows are worked out once, written by bucket: their folders say what they touch, and are the table if there was none.
        """
        alone = {"tables": {}}
        self._write(alone, name, new, bucket_of(user, now["buckets"]))
        touched = sorted(int(k) for k in alone["tables"][name]["parts"])
        old = self._read(now, name, touched)
        if old is None:
            now["tables"] |= alone["tables"]
        elif touched:
            merged = merge(old.unionByName(self._read(alone, name)))
            self._write(now, name, merged, bucket_of(user, now["buckets"]), touched)
        return touched

    def _merge_names(self, now: dict, table: str, rows: DataFrame | None, key: str, name: str) -> bool:
        """Merge names of campaigns or keywords, the smallest of each; whether any has changed."""
        if rows is None:
            return False
        alone = {"tables": {}}  # worked out once, from all spend rows
        self._write(alone, table, name_lookup(rows, key, name), F.lit(0).alias(BUCKET))
        new, old = self._read(alone, table), self._read(now, table)
        if old is None:
            now["tables"] |= alone["tables"]
            return False
        if new.join(old.withColumnRenamed(name, "old"), key, "left").filter(
            F.col("old").isNull() | (F.col(name) < F.col("old"))
        ).isEmpty():
            return False
        self._write(now, table, name_lookup(old.unionByName(new), key, name), F.lit(0).alias(BUCKET), [0])
        return True

    # Rows of users

    def _acquired(self, now: dict, buckets: list[int]) -> DataFrame:
        """New customers in the buckets, with their click and whether they have bought."""
        conversions = self._read(now, "conversions", buckets).select("app_user_id", "orderId", *TAGS)
        orders = self._read(now, "orders", buckets)
        if (keywords := self._read(now, "keywords")) is not None:
            conversions = attach_keyword_name(conversions, keywords)
        named = attach_campaign_name(clean_tags(conversions, self.channel), self._read(now, "campaigns"))
        first = orders.filter(within("first_transaction", self.start, self.end)).select(F.col("id").alias("app_user_id"))
        buyers = self._read(now, "sold", buckets).select(F.col("user_id").alias("app_user_id")).distinct()
        found = named.join(first, "app_user_id", "left_semi").join(buyers.withColumn("bought", F.lit(True)), "app_user_id", "left")
        return found.withColumnRenamed("app_user_id", "user_id").withColumn("bought", F.coalesce("bought", F.lit(False)))

    def _rows(self, sold: DataFrame, referrals: DataFrame, acquired: DataFrame) -> DataFrame:
        """Log rows of sold items and weekly referral metrics of new customers."""
        bought = sold.join(acquired.drop("bought"), "user_id")
        buyers = acquired.filter("bought").select("user_id", *ACQUISITION_COLUMNS)
        referred = attribute_referrals(referrals, buyers, self.start, self.end)
        return drop_tracking_columns(event_log_union(bought, referred))

    def refresh(self, batch: str, new: Increment) -> Refreshed:
        """Bring an increment into the log. ``batch`` names it; one that is in already is left alone."""
        number, now = self._state()
        if batch in now["batches"]:
            return Refreshed()
        n = now["buckets"]
        conversions = channel_conversions(new.events, self.channel, self.start, self.end).filter(F.col("app_user_id").isNotNull())
        conversions = first_conversions(conversions.select("app_user_id", "time", "orderId", *TAGS))
        firsts = new.store.transactions.groupBy(F.col("user_id").alias("id")).agg(F.min("created_at").alias("first_transaction"))
        earliest = lambda rows: rows.groupBy("id").agg(F.min("first_transaction").alias("first_transaction"))
        sold = transactions_extract(new.store, self.start, self.end)
        sold = drop_tracking_columns(add_week(date_transactions(sold, self.start, self.end)))

        touched = set(self._merge(now, "conversions", conversions, "app_user_id", first_conversions))
        touched |= set(self._merge(now, "orders", firsts.filter(F.col("id").isNotNull()), "id", earliest))
        renamed = self._merge_names(now, "campaigns", new.campaigns, "campaign_id", "campaign_name")
        renamed |= self._merge_names(now, "keywords", new.keywords, "keyword_id", "keyword")
        fresh = {}
        for name, rows, user in (("sold", sold, "user_id"), ("referrals", new.store.referrals, "influencer_id")):
            alone = {"tables": {}}  # the increment's rows apart, to append them to the log
            self._write(alone, name, rows, bucket_of(user, n))
            fresh[name] = alone
            table = now["tables"].setdefault(name, {"schema": rows.schema.jsonValue(), "parts": {}})
            for k, folders in alone["tables"][name]["parts"].items():
                table["parts"].setdefault(k, []).extend(folders)
        own = {int(k) for name in fresh for k in fresh[name]["tables"][name]["parts"]}
        check = list(range(n)) if renamed else sorted(touched | own)

        # whose click has changed
        old = self._read(now, "acquired", check)
        self._write(now, "acquired", self._acquired(now, check), bucket_of("user_id", n), check)
        acquired = self._read(now, "acquired", check)
        apart = acquired if old is None else acquired.exceptAll(old).unionByName(old.exceptAll(acquired))
        changed = set(self._buckets_in(now, apart, "user_id"))
        log = now["tables"].get("log", {"parts": {}})
        crowded = {int(k) for k, folders in log["parts"].items() if len(folders) >= self.parts}
        anew = sorted(changed | crowded & own)

        parts = []
        if anew:
            known = self._read(now, "acquired", anew)
            parts.append(self._rows(self._read(now, "sold", anew), self._read(now, "referrals", anew), known))
        added = sorted(own - set(anew))
        if added:
            known = self._read(now, "acquired", added)
            parts.append(self._rows(self._read(fresh["sold"], "sold", added), self._read(fresh["referrals"], "referrals", added), known))
        if parts:
            rows = reduce(lambda a, b: a.unionByName(b), parts)
            self._write(now, "log", rows, bucket_of("user_id", n), anew)
        self._write(now, "spend", add_week(new.spend), F.lit(0).alias(BUCKET))
        now["batches"].append(batch)
        self.versions.publish(now, number)
        return Refreshed(anew, added)

    def sold(self, buckets: list[int]) -> DataFrame:
        """The sold items that are read when these buckets are written anew."""
        return self._read(self._state()[1], "sold", buckets)

    def log(self) -> DataFrame:
        """The event log as of the last refresh."""
        number, now = self._state()
        if not number:
            raise ValueError(f"no log in {self.versions.root} yet")
        found = [rows for name in ("log", "spend") if (rows := self._read(now, name)) is not None]
        return drop_tracking_columns(event_log_union(*found))
