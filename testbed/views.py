"""Report exports, events and store tables derived from the test tables, whole, in their raw vocabulary.

``testbed/oracle.py`` defines the same tables in SQL. Only expressions both engines work out alike are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog.plans.event_logs import Sources, bing_event_log, display_event_log, search_event_log
from adlog.sources.events import flatten_events
from adlog.sources.reports import clean_bing_keyword_report, clean_campaign_report, clean_search_keyword_report
from adlog.sources.store import Store

START = "1995-03-01"
END = "2001-06-30"
COHORT_KEYWORD = "cold widget"
CAMPAIGN_PATTERN = "Core"


class Views:
    """The derived tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table; its file is looked at once, however often the table is used."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # Spend ---------------------------------------------------------------------------------------------

    def raw_search_keywords(self, *more: str) -> DataFrame:
        """The search keyword export: its own headers, device names, ``+`` and doubled blanks; with ``more`` columns behind."""
        rows = (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        return rows.selectExpr(
            "cast(l_shipdate AS date) AS `Day`",
            "date_format(cast(l_shipdate AS date), 'EEEE') AS `Day of week`",
            "concat('+', upper(replace(p_name, ' ', '  +'))) AS `Keyword`",
            "'enabled' AS `Keyword state`",
            "l_suppkey AS `Campaign ID`",
            "concat(CASE WHEN l_suppkey % 2 = 0 THEN 'Core ' ELSE 'Rmktg ' END, s_name) AS `Campaign`",
            "l_partkey AS `Ad group ID`",
            "p_brand AS `Ad group`",
            "cast(l_quantity * 25 AS decimal(18, 2)) AS `Cost`",
            "'Google search' AS `Network (with search partners)`",
            "l_tax * 10 AS `Search Impr. share`",
            "l_discount AS `Search Lost IS (rank)`",
            "CASE l_returnflag WHEN 'A' THEN 'Mobile devices with full browsers' "
            "WHEN 'R' THEN 'Tablets with full browsers' ELSE 'Computers' END AS `Device`",
            "cast(l_quantity AS bigint) * 100 AS `Impressions`",
            "cast(l_quantity AS bigint) % 7 AS `Clicks`",
            "1 + l_discount * 20 AS `Position`",
            "CASE WHEN l_linenumber = 7 THEN '--' ELSE cast(l_linenumber AS string) END AS `Quality score`",
            "'Average' AS `Landing page experience`",
            "CASE l_linenumber % 3 WHEN 0 THEN 'Broad' WHEN 1 THEN 'Exact' ELSE 'Phrase' END AS `Match type`",
            *more,
        )

    def raw_campaigns(self) -> DataFrame:
        """The campaign export: search spend per day, campaign and device."""
        rows = self.table("lineitem").join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        grouped = rows.selectExpr("*", "cast(l_shipdate AS date) AS day").groupBy(
            "day", "l_suppkey", "s_name", "l_returnflag"
        )
        return grouped.agg(
            F.sum("l_quantity").alias("quantity"),
            F.expr("sum(cast(l_quantity AS bigint) % 7)").alias("clicks"),
            F.max("l_tax").alias("tax"),
            F.max("l_discount").alias("discount"),
        ).selectExpr(
            "day AS `Day`",
            "date_format(day, 'EEEE') AS `Day of week`",
            "'enabled' AS `Campaign state`",
            "l_suppkey AS `Campaign ID`",
            "concat(CASE WHEN l_suppkey % 2 = 0 THEN 'Core ' ELSE 'Rmktg ' END, s_name) AS `Campaign`",
            "cast(quantity * 25 AS decimal(18, 2)) AS `Cost`",
            "'Display network' AS `Network (with search partners)`",
            "tax * 10 AS `Search Impr. share`",
            "discount AS `Search Lost IS (rank)`",
            "tax AS `Search Lost IS (budget)`",
            "CASE l_returnflag WHEN 'A' THEN 'Mobile devices with full browsers' "
            "WHEN 'R' THEN 'Tablets with full browsers' ELSE 'Computers' END AS `Device`",
            "cast(1000 AS decimal(18, 2)) AS `Budget`",
            "cast(quantity AS bigint) * 100 AS `Impressions`",
            "clicks AS `Clicks`",
            "1 + discount * 20 AS `Position`",
        )

    def raw_bing_keywords(self) -> DataFrame:
        """The second engine's keyword export."""
        rows = (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        return rows.selectExpr(
            "cast(l_shipdate AS date) AS `Gregorian date`",
            "l_partkey AS `Keyword ID`",
            "concat('+', upper(replace(p_name, ' ', ' +'))) AS `Keyword`",
            "'Active' AS `Keyword status`",
            "l_suppkey AS `Campaign ID`",
            "concat('Second ', s_name) AS `Campaign name`",
            "l_partkey AS `Ad group ID`",
            "p_brand AS `Ad group`",
            "cast(l_quantity * 20 AS decimal(18, 2)) AS `Spend`",
            "CASE l_returnflag WHEN 'A' THEN 'Smartphone' WHEN 'N' THEN 'Tablet' ELSE 'Computer' END AS `Device type`",
            "cast(l_quantity AS bigint) * 40 AS `Impressions`",
            "cast(l_quantity AS bigint) % 5 AS `Clicks`",
            "1 + l_discount * 10 AS `Avg. position`",
            "l_linenumber AS `Quality score`",
            "CASE l_linenumber % 3 WHEN 0 THEN 'Broad' WHEN 1 THEN 'Exact' ELSE 'Phrase' END AS `Delivered match type`",
        )

    def search_keywords(self) -> DataFrame:
        return clean_search_keyword_report(self.raw_search_keywords(), START, END)

    def campaigns(self) -> DataFrame:
        return clean_campaign_report(self.raw_campaigns(), START, END)

    def bing_keywords(self) -> DataFrame:
        return clean_bing_keyword_report(self.raw_bing_keywords(), START, END)

    # Events --------------------------------------------------------------------------------------------

    def nested_events(self) -> DataFrame:
        """The event export. Its time is the test events' month stretched over the orders' years."""
        rows = self.table("events").selectExpr("*", "cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS k")
        rows = rows.join(self.table("part"), F.col("k") == F.col("p_partkey"), "left")
        seconds = (
            "datediff(cast(ts AS date), DATE '2024-01-01') * 86400L "
            "+ hour(ts) * 3600L + minute(ts) * 60L + cast(second(ts) AS bigint)"
        )
        return rows.selectExpr(
            "CASE event_type WHEN 'purchase' THEN 'Completed Order' ELSE event_type END AS event",
            f"""struct(
                788918400L + 80L * ({seconds}) AS time,
                concat('d-', user_id) AS distinct_id,
                CASE WHEN value < 0.5 THEN 'anonymous' ELSE cast(user_id AS string) END AS id,
                concat('o-', event_id) AS orderId,
                CASE WHEN k < 70 THEN 'Google' ELSE 'Bing' END AS latest_ad_utm_source,
                CASE WHEN value < 5 THEN 'email' ELSE 'cpc' END AS latest_ad_utm_medium,
                CASE WHEN value >= 40 AND value < 42 THEN '(not set)'
                     ELSE cast(cast(floor(value / 10) AS bigint) AS string) END AS latest_ad_utm_campaign,
                CASE WHEN k < 70 THEN concat('+', upper(replace(p_name, ' ', '  +')))
                     ELSE concat('kwd-', k) END AS latest_ad_awkeyword,
                cast(k AS string) AS latest_ad_awadgroupid,
                CASE WHEN value < 20 THEN 'b' WHEN value < 60 THEN 'e' ELSE 'p' END AS latest_ad_awmatchtype,
                CASE WHEN minute(ts) < 30 THEN 'mb' ELSE 'dt' END AS latest_ad_device,
                'Metropolis' AS `$city`,
                concat('u', user_id, '@example.com') AS `$email`
            ) AS properties""",
        )

    def events(self) -> DataFrame:
        return flatten_events(self.nested_events())

    # Store ---------------------------------------------------------------------------------------------

    def store(self) -> Store:
        orders = self.table("orders")
        return Store(
            transactions=orders.selectExpr(
                "o_orderkey AS id",
                "o_custkey AS user_id",
                "o_orderdate AS created_at",
                "o_orderstatus <> 'P' AS complete",
                "o_orderpriority = '5-LOW' AS refunded",
                "cast(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '3-MEDIUM' THEN NULL ELSE 0 END "
                "AS decimal(18, 2)) AS credit",
                "cast(o_orderkey % 7 AS decimal(18, 2)) AS discount_amount",
                "cast(o_orderkey % 10 AS decimal(18, 2)) AS sales_tax_amount",
            ),
            transaction_items=self.table("lineitem").selectExpr(
                "l_orderkey AS transaction_id",
                "CASE WHEN l_linenumber <= 3 THEN l_partkey END AS discount_id",
                "cast(l_extendedprice AS decimal(18, 2)) AS price",
                "l_linestatus = 'F' AS recurring",
            ),
            discounts=self.table("part").selectExpr(
                "p_partkey AS id",
                "CASE p_type WHEN 'ECONOMY' THEN 'GiftCard' ELSE 'Promo' END AS type",
                "cast(p_retailprice AS decimal(18, 2)) AS amount",
            ),
            users=self.table("customer").selectExpr("c_custkey AS id", "c_name AS name"),
            referrals=orders.selectExpr(
                "o_custkey AS influencer_id",
                "date_sub(next_day(cast(o_orderdate AS date), 'MON'), 7) AS week_start",
                "o_totalprice",
            )
            .groupBy("influencer_id", "week_start")
            .agg(
                F.count("*").alias("new_referred_users"),
                F.expr("cast(sum(cast(o_totalprice AS decimal(18, 2))) AS decimal(18, 2))").alias(
                    "referred_users_transaction_amount"
                ),
            ),
        )

    # Event logs ----------------------------------------------------------------------------------------

    def sources(self) -> Sources:
        return Sources(self.search_keywords(), self.campaigns(), self.bing_keywords(), self.events(), self.store())

    def search_log(self, stage=None) -> DataFrame:
        return search_event_log(
            self.search_keywords(), self.campaigns(), self.events(), self.store(), START, END, stage
        )

    def bing_log(self, stage=None) -> DataFrame:
        return bing_event_log(self.bing_keywords(), self.events(), self.store(), START, END, stage)

    def display_log(self, stage=None) -> DataFrame:
        return display_event_log(self.campaigns(), self.events(), self.store(), START, END, stage)
