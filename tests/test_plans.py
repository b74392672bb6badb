"""Physical plans: what is shuffled, pushed down and kept apart."""

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from adlog.channels import SEARCH
from adlog.functions.joins import left_join_spreading_nulls
from adlog.operators import attribution, cohorts, reports, series
from adlog.sources import events as event_source
from adlog.sources import store as store_source
from conftest import plan_of, rows
from testbed.queries import QUERIES, search_transactions
from testbed.views import COHORT_KEYWORD, END, START

ACTIONS = {"marketing_report", "write_report_csv", "first_transaction_snapshot", "event_log_refresh", "acquisitions_rollup", "kpi_grouping_sets", "kpi_grouping_sets_bing", "rejected_report_rows", "conversions_streamed", "series_resumed", "published_reports"}
# These broadcast the numbered weeks of the calendar.
BROADCAST_CALENDAR = {"cohort_assignment", "cohort_label"}


@contextmanager
def settings(spark, **values):
    """SQL settings for a while; ``__`` stands for a dot."""
    names = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ACTIONS))
def test_every_plan(spark, views, name):
    with settings(spark, autoBroadcastJoinThreshold=-1):
        plan = plan_of(QUERIES[name](views))
    # No cross join, no Python, and no broadcast but those Spark decides on by size.
    for word in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert word not in plan
    assert "Broadcast" not in plan or name in BROADCAST_CALENDAR
    # Whatever runs in a single task comes after an aggregate.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(text for text in lines[i + 1 :] if not re.search(r"Project|Sort|Filter", text))
            assert "Aggregate" in below, below


def test_conversions_are_cut_down_before_the_shuffle(spark, views):
    conversions = event_source.channel_conversions(views.events(), SEARCH, START, END)
    plan = plan_of(attribution.one_conversion_per_user(conversions))
    final, shuffle, partial = (plan.index(word) for word in ("row_number(), 1, Final", "Exchange hash", "row_number(), 1, Partial"))
    assert final < shuffle < partial


def test_sums_are_hash_aggregates_of_primitives(spark, views):
    log = views.search_log()
    for frame in (
        reports.keywords_report(log),
        series.overall_performance_over_time(log),
        reports.orders_per_week(log),
        reports.customers_per_month(log),
    ):
        assert "SortAggregate" not in plan_of(frame).split("Union")[0]


def test_cumulative_series_needs_one_shuffle_per_grain(spark, views):
    plan = plan_of(series.keywords_performance_over_time(views.search_log())).split("Union")[0]
    # One for the weekly sums, one for both windows.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_campaign_pattern_goes_below_the_aggregate(spark, views):
    plan = plan_of(reports.weekly_conversion_metrics(views.search_log(), "Core"))
    assert "RLIKE" not in plan.split("HashAggregate")[0]
    assert re.search(r"RLIKE|Contains|contains|Core", plan.split("Union")[1])


def test_cohorts_read_the_log_once(spark, views):
    def scans(frame):
        return plan_of(frame).count("FileScan")

    log = views.search_log()
    needed = log.filter(F.col("keyword") == COHORT_KEYWORD).select(
        "week", "user_id", "cost", "money_in_the_bank_paid_to_us"
    )
    assert scans(cohorts.cohort_breakeven(log, COHORT_KEYWORD)) == scans(needed)


def native_store(spark, views, folder):
    """The store's tables as files of their own."""
    tables = views.store()
    for name in ("transactions", "transaction_items", "discounts", "users", "referrals"):
        getattr(tables, name).write.parquet(f"{folder}/{name}")
    return store_source.Store(
        **{name: spark.read.parquet(f"{folder}/{name}") for name in tables.__dataclass_fields__}
    )


def test_window_and_columns_reach_the_scan(spark, views, tmp_path):
    tables = native_store(spark, views, tmp_path)
    frame = store_source.transactions_extract(tables, START, END).select("user_name", "refund_amount")
    assert frame.count() == views.table("lineitem").join(views.table("orders"), F.expr("l_orderkey = o_orderkey")).filter(
        f"o_orderstatus <> 'P' AND o_orderdate BETWEEN DATE '{START}' AND DATE '{END}' + INTERVAL 1 DAY"
    ).count()
    with settings(spark, maxMetadataStringLength=2000):
        scans = [line for line in plan_of(frame).splitlines() if "FileScan" in line]
    (transactions,) = [line for line in scans if "created_at#" in line]
    assert "GreaterThanOrEqual(created_at" in transactions and "LessThanOrEqual(created_at" in transactions
    assert "EqualTo(complete,true)" in transactions
    (items,) = [line for line in scans if "price#" in line]
    assert "ReadSchema: struct<transaction_id:bigint,discount_id:bigint,price:decimal(18,2)>" in items


def read_columns(frame, column: str) -> set[str]:
    """The columns that the scan with ``column`` reads."""
    with settings(frame.sparkSession, maxMetadataStringLength=4000):
        scans = [line for line in plan_of(frame).splitlines() if "FileScan" in line and f"{column}#" in line]
    (schema,) = {re.search(r"ReadSchema: struct<(.*)>", line)[1] for line in scans}
    return set(re.findall(r"(\w+):", schema))


def test_joins_that_spread_nulls_read_only_what_is_asked_for(spark, views, tmp_path):
    conversions = event_source.channel_conversions(views.events(), SEARCH, START, END)
    attribution.clean_tags(conversions, SEARCH).write.parquet(f"{tmp_path}/clean")
    clean = spark.read.parquet(f"{tmp_path}/clean")
    named = attribution.attach_campaign_name(clean, attribution.campaign_lookup(views.campaigns()))
    assert read_columns(named.select("orderId", "campaign_name"), "orderId") == {"campaign_id", "app_user_id", "orderId"}

    conversions.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    worded = attribution.attach_keyword_name(raw, attribution.keyword_lookup(views.bing_keywords()))
    assert read_columns(worded.select("orderId", "keyword"), "orderId") == {"latest_ad_awkeyword", "app_user_id", "orderId"}

    views.search_log().write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    with settings(spark, autoBroadcastJoinThreshold=-1):
        placed = cohorts.cohort_assignment(log, COHORT_KEYWORD).select("cohort", "cost")
        scans = [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<(.*)>", plan_of(placed))]
    assert max(scans, key=len) == {"keyword", "week", "user_id", "cost", "date", "campaign_id"}


def test_bucketed_items_are_not_shuffled(spark, views, tmp_path):
    """The layout the README recommends: items and transactions in buckets of the transaction."""
    tables = views.store()
    writer = tables.transaction_items.write.bucketBy(8, "transaction_id").sortBy("transaction_id")
    writer.option("path", str(tmp_path / "items")).saveAsTable("bucketed_items")
    bucketed = store_source.Store(
        tables.transactions, spark.table("bucketed_items"), tables.discounts, tables.users, tables.referrals
    )
    with settings(spark, autoBroadcastJoinThreshold=-1):
        frame, plain = (store_source.transactions_extract(store, START, END) for store in (bucketed, tables))
        shuffles = [plan_of(f).count("Exchange hashpartitioning(transaction_id") for f in (frame, plain)]
        assert shuffles == [1, 2]
        assert rows(frame.groupBy("purchase_type").count()) == rows(plain.groupBy("purchase_type").count())


def test_null_keys_are_spread_over_the_tasks(spark):
    left = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 50).alias("key"))
    right = spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    with settings(spark, autoBroadcastJoinThreshold=-1, adaptive__enabled="false", shuffle__partitions=8):
        joined = left_join_spreading_nulls(left, right, "key", ["id"])
        plain = left.join(right, "key", "left")
        assert "__null_spread" in plan_of(joined).split("SortMergeJoin")[1].splitlines()[0]
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
        worst = max(row["count"] for row in plain.groupBy(F.spark_partition_id()).count().collect())
        assert rows(joined.select(plain.columns)) == rows(plain)
    assert worst >= 36_000
    assert max(sizes) < 40_000 * 0.25


def test_equal_sort_values_do_not_share_a_task(spark):
    day = F.lit("2016-05-01").cast("date").alias("date")
    idle = spark.range(20_000).select(
        F.lit(0.0).alias("earnings"), F.col("id").cast("string").alias("keyword"), F.lit("c").alias("campaign_name"),
        F.lit("Exact").alias("match_type"), day,
    )
    with settings(spark, adaptive__enabled="false", shuffle__partitions=8):
        for frame in (reports.best_earners_first(idle), store_source.campaign_stage(idle, "2016-05-01", "2016-05-01")):
            tasks = [row[0] for row in frame.select(F.spark_partition_id()).collect()]
            assert len(tasks) == 20_000 and max(Counter(tasks).values()) < 20_000 * 0.25


def skewed_store(spark, views):
    """The store with one user owning a third of the transactions, one transaction a third of the items, and a
    discount on a third of them."""
    tables = views.store()
    bought = search_transactions(views).select("user_id").distinct().agg(F.max("user_id")).head()[0]
    transactions = tables.transactions.withColumn(
        "user_id", F.when(F.col("id") % 3 == 0, F.lit(bought)).otherwise(F.col("user_id"))
    )
    hot = transactions.filter((F.col("user_id") == bought) & F.col("complete")).agg(F.max("id")).head()[0]
    items = tables.transaction_items.withColumns(
        {
            "transaction_id": F.when(F.col("price") % 3 < 1, F.lit(hot)).otherwise(F.col("transaction_id")),
            "discount_id": F.when(F.col("price") % 3 >= 2, F.lit(7)).otherwise(F.col("discount_id")),
        }
    )
    return store_source.Store(transactions, items, tables.discounts, tables.users, tables.referrals)


def final_plan(frame) -> str:
    """The plan AQE ended with."""
    frame._jdf.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_and_nothing_is_lost(spark, views):
    tables = skewed_store(spark, views)
    frame = store_source.transactions_extract(tables, START, END)
    expected = rows(frame.groupBy("app_user_id").agg(F.count("*"), F.sum("money_in_the_bank_paid_to_us")))
    small = dict(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4KB",
        adaptive__coalescePartitions__enabled="false",
        files__maxPartitionBytes="16KB",
        files__openCostInBytes="0",
    )
    with settings(spark, **small):
        split = store_source.transactions_extract(
            store_source.Store(
                tables.transactions.repartition(8), tables.transaction_items.repartition(8), tables.discounts, tables.users, tables.referrals
            ),
            START,
            END,
        )
        assert "skew=true" in final_plan(split)
        found = rows(split.groupBy("app_user_id").agg(F.count("*"), F.sum("money_in_the_bank_paid_to_us")))
    assert found == expected
