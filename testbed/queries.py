"""Every registered query: the engine's operator on the derived tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlog import schemas
from adlog.channels import BING, BING_DEVICES, SEARCH, SEARCH_DEVICES
from adlog.functions import scalars
from adlog.operators import attribution, cohorts, filters, kpis, reports, rollups, series
from adlog.plans.event_logs import acquisitions, event_logs, transaction_rows
from adlog.plans.kept_log import Increment, KeptLog
from adlog.plans.kept_series import KeptSeries
from adlog.plans.marketing_report import Focus, chart_frames, marketing_report
from adlog.plans.published import publish_reports, published_reports
from adlog.sources import events as event_source
from adlog.sources import reports as report_source
from adlog.sources import quarantine, sinks
from adlog.sources import store as store_source
from adlog.sources.snapshot import FirstOrders
from adlog.streaming import firsts
from testbed import oracle as sql
from testbed.oracle import BING_LOG_COLUMNS, LOG_COLUMNS, WINDOW, dated, earning, kpi, shown
from testbed.views import CAMPAIGN_PATTERN, COHORT_KEYWORD, END, START, Views

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

FOCUS = Focus(keyword=COHORT_KEYWORD, campaign=CAMPAIGN_PATTERN)
AS_OF = END


# Integer columns that hold NULLs, by query. They are compared as doubles: data frames of the two engines do not
# agree on how to hold an integer that may be missing.
LOG_GAPS = ["campaign_id", "ad_group_id", "impressions", "clicks", "user_id", "new_referred_users"]
GAPS = {
    "order_conversion_events": ["app_user_id"],
    "one_conversion_per_user": ["app_user_id"],
    "conversions_streamed": ["app_user_id"],
    "keyword_id_from_tag": ["keyword_id"],
    "attach_campaign_name": ["campaign_id"],
    "clean_transactions": ["campaign_id"],
    "clean_transactions_bing": ["campaign_id"],
    "first_acquisition": ["campaign_id"],
    "attribute_referrals": ["campaign_id"],
    "search_event_log": LOG_GAPS,
    "event_log_refresh": LOG_GAPS,
    "bing_event_log": LOG_GAPS,
    "display_event_log": LOG_GAPS,
    "cohort_assignment": ["user_id"],
    "cohort_breakeven": ["weeks_until_breakeven"],
    "cohort_breakeven_bing": ["weeks_until_breakeven"],
}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLE[name] = sql.with_tables(oracle)
        if name in GAPS:
            casts = ", ".join(f"CAST({column} AS DOUBLE) AS {column}" for column in GAPS[name])
            ORACLE[name] = f"SELECT * REPLACE ({casts}) FROM ({ORACLE[name]})"
        return run

    return register


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query as the driver calls it, with dates as text and money as double."""
    return lambda spark, folder: comparable(QUERIES[name](Views(spark, folder)), GAPS.get(name, []))


def comparable(rows: DataFrame, gaps: list[str]) -> DataFrame:
    def cell(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType) or field.name in gaps:
            return column.cast("double").alias(field.name)
        return column

    return rows.select(*[cell(field) for field in rows.schema.fields])


def counted(rows: DataFrame, *columns: Column) -> DataFrame:
    """How often each combination occurs."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n_rows"))


# Ingest ----------------------------------------------------------------------------------------------------

KW_COLUMNS = [name for name, _ in schemas.SEARCH_KEYWORD_COLUMNS.values()]
CAMPAIGN_REPORT_COLUMNS = [name for name, _ in schemas.CAMPAIGN_COLUMNS.values()]
BING_KW_COLUMNS = [name for name, _ in schemas.BING_KEYWORD_COLUMNS.values()] + ["day_of_week"]


def exported(raw: DataFrame, label: str) -> str:
    """The export as CSV files with headers, in a staged folder."""
    path = sinks.new_folder(raw.sparkSession, label)
    raw.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("ingest_search_keyword_report", shown(KW_COLUMNS, "kw"))
def _(v):
    path = exported(v.raw_search_keywords(), "keywords")
    return report_source.read_search_keyword_report(v.spark, path, START, END).select(KW_COLUMNS)


@query("ingest_campaign_report", shown(CAMPAIGN_REPORT_COLUMNS, "camp"))
def _(v):
    path = exported(v.raw_campaigns(), "campaigns")
    return report_source.read_campaign_report(v.spark, path, START, END).select(CAMPAIGN_REPORT_COLUMNS)


@query("ingest_bing_keyword_report", shown(BING_KW_COLUMNS, "bing_kw"))
def _(v):
    raw = v.raw_bing_keywords()
    day = F.date_format("Gregorian date", report_source.BING_DATE_PATTERN)
    path = exported(raw.withColumn("Gregorian date", day), "second-engine")
    frame = ['"Report Name: Keyword performance"'] * 9 + ["(c) All rights reserved. "]
    v.spark.createDataFrame([(line,) for line in frame], "value STRING").write.mode("append").text(path)
    return report_source.read_bing_keyword_report(v.spark, path, START, END).select(BING_KW_COLUMNS)


@query(
    "order_conversion_events",
    """SELECT CASE source WHEN 'Google' THEN 'search' ELSE 'bing' END AS channel, app_user_id, time,
        order_id AS "orderId" FROM conv""",
)
def _(v):
    lines = v.nested_events().select(F.to_json(F.struct("event", "properties")).alias("value"))
    parsed = lines.select(F.from_json("value", schemas.EVENT).alias("e")).select("e.*")
    flat = event_source.flatten_events(parsed)
    parts = [
        rows.select(F.lit(name).alias("channel"), "app_user_id", "time", "orderId")
        for name, rows in event_source.conversions_by_channel(flat, START, END).items()
    ]
    return attribution.event_log_union(*parts)


#: Faults planted in the search keyword export: a cost that is no number, a day that is no date, a line cut off.
NO_COST, NO_DAY, CUT = "l_linenumber = 1 AND l_quantity = 13", "l_linenumber = 2 AND l_quantity = 17", "l_linenumber = 3 AND l_quantity = 19"


@query(
    "rejected_report_rows",
    f"""SELECT campaign_id, reason, COUNT(*) AS n_rows FROM (
        SELECT CASE WHEN {CUT} THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS campaign_id,
            CASE WHEN {NO_COST} THEN 'cost: 12 EUR' WHEN {NO_DAY} THEN 'date: soon' ELSE 'number of fields' END AS reason
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE ({NO_COST}) OR ({NO_DAY}) OR ({CUT})) GROUP BY campaign_id, reason""",
)
def _(v):
    raw = v.raw_search_keywords("l_linenumber", "l_quantity")
    raw = raw.withColumns(
        {
            "Cost": F.expr(f"CASE WHEN {NO_COST} THEN '12 EUR' ELSE cast(Cost AS string) END"),
            "Day": F.expr(f"CASE WHEN {NO_DAY} THEN 'soon' ELSE cast(Day AS string) END"),
        }
    )
    path = exported(raw.filter(f"NOT ({CUT})").drop("l_linenumber", "l_quantity"), "faulty-keywords")
    raw.filter(CUT).select(F.concat_ws(",", "Day", "`Day of week`")).write.mode("append").text(path)
    found = quarantine.checked_search_keyword_report(v.spark, path).rejected
    cell = F.when(F.col("reason") != quarantine.WRONG_FIELDS, F.col("campaign_id")).alias("campaign_id")
    return counted(found.withColumn("reason", F.explode("reasons")), cell, F.col("reason"))


# Store extracts --------------------------------------------------------------------------------------------


@query(
    "transactions_extract",
    """SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, user_name, app_user_id,
        CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(credit AS DOUBLE) AS credit,
        CAST(sales_tax_amount AS DOUBLE) AS sales_tax_amount, CAST(refund_amount AS DOUBLE) AS refund_amount,
        CAST(retail_price AS DOUBLE) AS retail_price,
        CAST(money_in_the_bank_paid_to_us AS DOUBLE) AS money_in_the_bank_paid_to_us, purchase_type FROM extract""",
)
def _(v):
    return store_source.transactions_extract(v.store(), START, END)


@query(
    "referrals_scan",
    shown(["influencer_id", "week_start", "new_referred_users", "referred_users_transaction_amount"], "ref"),
)
def _(v):
    return store_source.referrals(v.store())


@query(
    "first_transaction_dates",
    "SELECT CAST(first_transaction AS VARCHAR) AS first_transaction, id, name FROM first_tx",
)
def _(v):
    return store_source.first_transaction_dates(v.store(), START, END)


def order_batches(rows: DataFrame, key: str, day: str) -> list[DataFrame]:
    """All rows in three batches: early ones, later ones, and those of every tenth key, which come last whatever their day."""
    late = F.col(key) % 10 == 0
    early = F.col(day).cast("date") < F.lit("1998-01-01").cast("date")
    return [rows.filter(~late & early), rows.filter(~late & ~early), rows.filter(late)]


@query(
    "first_transaction_snapshot",
    "SELECT CAST(first_transaction AS VARCHAR) AS first_transaction, id, name FROM first_tx",
)
def _(v):
    store = v.store()
    kept = FirstOrders(v.spark, sinks.new_folder(v.spark, "first-orders"), buckets=8)
    for batch in order_batches(store.transactions, "id", "created_at"):
        kept.add(batch)
    tables = {name: getattr(store, name) for name in store.__dataclass_fields__}
    return store_source.first_transaction_dates(store_source.KeptStore(**tables, first_orders=kept.rows()), START, END)


STAGED = ["date", "campaign_id", "campaign_name", "device", "cost", "impressions", "clicks"]


@query("campaign_stage_scan", shown(STAGED, f"(SELECT * FROM raw_camp WHERE date {WINDOW} ORDER BY date DESC)"))
def _(v):
    names = ["Day", "Campaign ID", "Campaign", "Device", "Cost", "Impressions", "Clicks"]
    staged = report_source.rename_headers(v.raw_campaigns().select(names), schemas.CAMPAIGN_COLUMNS)
    staged = staged.withColumn("device", scalars.relabel(F.col("device"), SEARCH_DEVICES))
    return store_source.campaign_stage(staged, START, END)


@query("query_parameters", shown(STAGED, "camp"))
def _(v):
    names = ["Day", "Campaign ID", "Campaign", "Device", "Cost", "Impressions", "Clicks"]
    staged = report_source.rename_headers(v.raw_campaigns().select(names), schemas.CAMPAIGN_COLUMNS)
    staged = staged.withColumn("device", scalars.relabel(F.col("device"), SEARCH_DEVICES))
    path = str(Path(__file__).with_name("campaign_stage.sql"))
    return store_source.run_query_file(v.spark, path, {"start": START, "end": END}, {"campaigns": staged})


# Scalars ---------------------------------------------------------------------------------------------------


@query(
    "normalize_keyword",
    """SELECT raw, replace(replace(lower(raw), '+', ''), '  ', ' ') AS keyword, COUNT(*) AS n_rows
    FROM (SELECT '+' || upper(replace(p_name, ' ', '  +')) AS raw FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY 1, 2""",
)
def _(v):
    raw = F.col("Keyword")
    return counted(v.raw_search_keywords(), raw.alias("raw"), scalars.normalize_keyword(raw).alias("keyword"))


@query(
    "normalize_keyword_bing",
    """SELECT raw, replace(lower(raw), '+', '') AS keyword, COUNT(*) AS n_rows
    FROM (SELECT '+' || upper(replace(p_name, ' ', ' +')) AS raw FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY 1, 2""",
)
def _(v):
    raw = F.col("Keyword")
    return counted(v.raw_bing_keywords(), raw.alias("raw"), scalars.normalize_keyword_bing(raw).alias("keyword"))


@query(
    "normalize_device",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'Mobile devices with full browsers'
            WHEN 'R' THEN 'Tablets with full browsers' ELSE 'Computers' END AS raw,
        CASE WHEN l_returnflag = 'A' THEN 'mb' ELSE 'dt' END AS device, COUNT(*) AS n_rows
    FROM lineitem GROUP BY 1, 2""",
)
def _(v):
    raw = F.col("Device")
    return counted(v.raw_search_keywords(), raw.alias("raw"), scalars.relabel(raw, SEARCH_DEVICES).alias("device"))


@query(
    "normalize_device_bing",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'Smartphone' WHEN 'N' THEN 'Tablet' ELSE 'Computer' END AS raw,
        CASE WHEN l_returnflag = 'A' THEN 'mb' ELSE 'dt' END AS device, COUNT(*) AS n_rows
    FROM lineitem GROUP BY 1, 2""",
)
def _(v):
    raw = F.col("Device type")
    return counted(v.raw_bing_keywords(), raw.alias("raw"), scalars.relabel(raw, BING_DEVICES).alias("device"))


@query("normalize_match_type", "SELECT match_type, COUNT(*) AS n_rows FROM ev GROUP BY match_type")
def _(v):
    match_type = scalars.normalize_match_type(F.col("latest_ad_awmatchtype"))
    return counted(v.events(), match_type.alias("match_type"))


@query(
    "monday_week",
    """SELECT CAST(day AS VARCHAR) AS day, CAST(CAST(date_trunc('week', day + 1) AS DATE) AS VARCHAR) AS week,
        COUNT(*) AS n_rows FROM (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem) GROUP BY 1, 2""",
)
def _(v):
    day = F.col("l_shipdate").cast("date")
    return counted(v.table("lineitem"), day.alias("day"), scalars.monday_week(day).alias("week"))


@query(
    "day_of_week",
    "SELECT dayname(CAST(l_shipdate AS DATE)) AS day_of_week, COUNT(*) AS n_rows FROM lineitem GROUP BY 1",
)
def _(v):
    return counted(
        v.table("lineitem"), scalars.day_of_week(F.col("l_shipdate").cast("date")).alias("day_of_week")
    )


@query("keyword_id_from_tag", "SELECT keyword_id, COUNT(*) AS n_rows FROM ev GROUP BY keyword_id")
def _(v):
    tag = F.col("latest_ad_awkeyword")
    return counted(v.events(), scalars.keyword_id_from_tag(tag).alias("keyword_id"))


@query(
    "month_bucket",
    """SELECT CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS month, strftime(day, '%Y-%m') AS label,
        COUNT(*) AS n_rows FROM (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem) GROUP BY 1, 2""",
)
def _(v):
    day = F.col("l_shipdate").cast("date")
    return counted(
        v.table("lineitem"), scalars.month_bucket(day).alias("month"), scalars.month_label(day).alias("label")
    )


@query(
    "capped_share",
    """SELECT share, CASE WHEN share >= 1 THEN 1.0::DOUBLE ELSE share END AS capped, COUNT(*) AS n_rows
    FROM (SELECT l_tax * 12.5 AS share FROM lineitem) GROUP BY 1, 2""",
)
def _(v):
    share = F.col("l_tax") * 12.5
    return counted(v.table("lineitem"), share.alias("share"), scalars.capped_share(share).alias("capped"))


@query("cohort_label", "SELECT 'cohort_' || cohort_week AS cohort, COUNT(*) AS n_rows FROM cohorts GROUP BY 1")
def _(v):
    return counted(cohorts.cohort_assignment(v.search_log(), COHORT_KEYWORD), F.col("cohort"))


# Filters ---------------------------------------------------------------------------------------------------


@query(
    "date_filter",
    f"""SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS n_rows FROM raw_bing WHERE date {WINDOW} GROUP BY 1""",
)
def _(v):
    rows = v.raw_bing_keywords().withColumnRenamed("Gregorian date", "date")
    return counted(filters.date_filter(rows, START, END), F.col("date"))


@query(
    "filter_keyword",
    dated(f"""SELECT week, COUNT(*) AS n_rows, COUNT(user_id) AS n_user_rows FROM log_search
    WHERE keyword = '{COHORT_KEYWORD}' GROUP BY week"""),
)
def _(v):
    rows = filters.filter_keyword(v.search_log(), COHORT_KEYWORD)
    return rows.groupBy("week").agg(F.count("*").alias("n_rows"), F.count("user_id").alias("n_user_rows"))


@query(
    "filter_campaign",
    f"""SELECT campaign_name, COUNT(*) AS n_rows FROM log_search
    WHERE regexp_matches(campaign_name, '{CAMPAIGN_PATTERN}') GROUP BY campaign_name""",
)
def _(v):
    return counted(filters.filter_campaign(v.search_log(), CAMPAIGN_PATTERN), F.col("campaign_name"))


@query(
    "filter_earning",
    f"""SELECT keyword, campaign_name, cost, earnings FROM ({kpi("log_search", ["keyword", "campaign_name"])})
    WHERE cost > 0 AND earnings > 0""",
)
def _(v):
    summary = kpis.summarize_elog(v.search_log(), "keyword", "campaign_name")
    return filters.filter_earning(summary, paid_only=True).select("keyword", "campaign_name", "cost", "earnings")


@query(
    "filter_display_remarketing",
    """SELECT campaign_name, device, COUNT(*) AS n_rows FROM log_display_all
    WHERE campaign_name LIKE '%Rmktg%' GROUP BY campaign_name, device""",
)
def _(v):
    return counted(v.display_log(), F.col("campaign_name"), F.col("device"))


METRICS = [
    "keyword",
    "campaign_name",
    "week",
    "est_search_impression_share",
    "impressions",
    "clicks",
    "num_acquisitions",
    "click_through_rate",
    "conversion_rate",
    "cost_per_click",
    "contribution_per_click",
]
BING_METRICS = [name for name in METRICS if name != "est_search_impression_share"]
METRICS_SQL = f"""SELECT {", ".join(METRICS)} FROM (
    SELECT * REPLACE (CASE WHEN est_search_impression_share >= 1 THEN 1.0::DOUBLE
        ELSE est_search_impression_share END AS est_search_impression_share)
    FROM ({kpi("log_search", ["keyword", "campaign_name", "week"])})
    WHERE regexp_matches(campaign_name, '{CAMPAIGN_PATTERN}'))"""


RECENT_SQL = f"""SELECT * FROM ({METRICS_SQL}) WHERE keyword = '{COHORT_KEYWORD}'
    AND week BETWEEN DATE '{AS_OF}' - 28 AND DATE '{AS_OF}'"""


@query("recent_weeks", dated(RECENT_SQL))
def _(v):
    metrics = reports.weekly_conversion_metrics(v.search_log(), CAMPAIGN_PATTERN)
    return filters.recent_weeks(metrics, AS_OF, COHORT_KEYWORD)


DEVICE_KEYS = ["keyword", "device"]


@query(
    "device_slice",
    dated(sql.series("log_search", DEVICE_KEYS, where=f"device = 'dt' AND {earning('log_search')}")),
)
def _(v):
    return series.device_performance_over_time(v.search_log(), device=filters.DESKTOP, earning_only=True)


@query("device_slice_mobile", dated(sql.series("log_search", DEVICE_KEYS, where="device = 'mb'")))
def _(v):
    return series.device_performance_over_time(v.search_log(), device=filters.MOBILE)


@query(
    "monetary_rows",
    """SELECT user_id, COUNT(*) AS n_rows, COUNT(date) AS n_dated FROM log_search WHERE user_id IS NOT NULL
    GROUP BY user_id""",
)
def _(v):
    rows = filters.monetary_rows(v.search_log())
    return rows.groupBy("user_id").agg(F.count("*").alias("n_rows"), F.count("date").alias("n_dated"))


REFERRAL_COLUMNS = ["user_id", "week", "new_referred_users", "referred_users_transaction_amount"]


@query(
    "referral_window",
    shown(REFERRAL_COLUMNS, f"""(SELECT *, influencer_id AS user_id, week_start AS week FROM ref
    WHERE week_start {WINDOW})"""),
)
def _(v):
    weekly = v.store().referrals.withColumnsRenamed({"influencer_id": "user_id", "week_start": "week"})
    return filters.referral_window(weekly, START, END).select(REFERRAL_COLUMNS)


# Joins, union, reshape -------------------------------------------------------------------------------------


@query(
    "one_conversion_per_user",
    """SELECT app_user_id, time, order_id AS "orderId" FROM conv_one WHERE source = 'Google'""",
)
def _(v):
    conversions = event_source.channel_conversions(v.events(), SEARCH, START, END)
    return attribution.one_conversion_per_user(conversions).select("app_user_id", "time", "orderId")


def arrivals(v: Views, rows: DataFrame, late: Column, early: Column) -> Iterator[str]:
    """A folder into which Parquet files come in three times, written by all tasks; the last time brings early rows late."""
    folder = sinks.new_folder(v.spark, "stream")
    for part in (~late & early, ~late & ~early, late):
        rows.filter(part).write.mode("append").parquet(folder)
        yield folder


@query(
    "conversions_streamed",
    """SELECT app_user_id, time, order_id AS "orderId" FROM conv_one WHERE source = 'Google'""",
)
def _(v):
    events = v.events()
    number = F.regexp_extract("orderId", "([0-9]+)", 1).cast("long")
    folders = arrivals(v, events, number % 10 == 0, F.timestamp_seconds("time") < F.lit("1998-01-01").cast("timestamp"))
    table, checkpoint = sinks.new_folder(v.spark, "firsts"), sinks.new_folder(v.spark, "firsts-checkpoint")

    def take(folder: str) -> None:
        stream = v.spark.readStream.schema(events.schema).parquet(folder)
        firsts.keep_up(firsts.first_conversions(stream, SEARCH, START, END), table, checkpoint)

    for folder in folders:
        take(folder)
    take(folder)  # finds nothing new
    return firsts.kept(v.spark, table, "app_user_id", ["time", "orderId"]).select("app_user_id", "time", "orderId")


@query(
    "join_conversions",
    """SELECT e.app_user_id, c.order_id AS "orderId", COUNT(*) AS n_rows,
        CAST(SUM(e.money_in_the_bank_paid_to_us) AS DOUBLE) AS earned
    FROM extract e JOIN conv_one c ON e.app_user_id = c.app_user_id WHERE c.source = 'Google'
    GROUP BY e.app_user_id, c.order_id""",
)
def _(v):
    conversions = attribution.one_conversion_per_user(
        event_source.channel_conversions(v.events(), SEARCH, START, END)
    )
    rows = attribution.join_conversions(store_source.transactions_extract(v.store(), START, END), conversions)
    earned = F.sum("money_in_the_bank_paid_to_us").cast("double").alias("earned")
    return rows.groupBy("app_user_id", "orderId").agg(F.count("*").alias("n_rows"), earned)


@query(
    "new_customers_only",
    """SELECT app_user_id, COUNT(*) AS n_rows FROM extract WHERE app_user_id IN (SELECT id FROM first_tx)
    GROUP BY app_user_id""",
)
def _(v):
    sold = store_source.transactions_extract(v.store(), START, END)
    first = store_source.first_transaction_dates(v.store(), START, END)
    return counted(attribution.new_customers_only(sold, first), F.col("app_user_id"))


@query(
    "attach_campaign_name",
    """SELECT c.order_id AS "orderId", c.campaign_id, n.campaign_name FROM conv c
    LEFT JOIN camp_names n ON c.campaign_id = n.campaign_id WHERE c.source = 'Google'""",
)
def _(v):
    conversions = event_source.channel_conversions(v.events(), SEARCH, START, END)
    named = attribution.attach_campaign_name(
        attribution.clean_tags(conversions, SEARCH), attribution.campaign_lookup(v.campaigns())
    )
    return named.select("orderId", "campaign_id", "campaign_name")


@query(
    "attach_keyword_name",
    """SELECT c.order_id AS "orderId", c.keyword_id, w.keyword FROM conv c
    LEFT JOIN bing_words w ON c.keyword_id = w.keyword_id WHERE c.source = 'Bing'""",
)
def _(v):
    conversions = event_source.channel_conversions(v.events(), BING, START, END)
    named = attribution.attach_keyword_name(conversions, attribution.keyword_lookup(v.bing_keywords()))
    return named.select("orderId", "keyword_id", "keyword")


TAGS = ["keyword", "campaign_name", "campaign_id", "device", "match_type"]


def search_transactions(v: Views) -> DataFrame:
    names = attribution.campaign_lookup(v.campaigns())
    return transaction_rows(v.store(), acquisitions(v.events(), v.store(), SEARCH, names, START, END), START, END)


@query("first_acquisition", f"SELECT DISTINCT user_id, {', '.join(TAGS)} FROM sold_search")
def _(v):
    return attribution.first_acquisition(search_transactions(v))


@query(
    "attribute_referrals",
    shown(
        [*REFERRAL_COLUMNS, *TAGS],
        f"""(SELECT r.influencer_id AS user_id, r.week_start AS week, r.new_referred_users,
            r.referred_users_transaction_amount, a.* EXCLUDE (user_id)
        FROM ref r JOIN (SELECT DISTINCT user_id, {", ".join(TAGS)} FROM sold_search) a
            ON r.influencer_id = a.user_id WHERE r.week_start {WINDOW})""",
    ),
)
def _(v):
    acquired = attribution.first_acquisition(search_transactions(v))
    rows = attribution.attribute_referrals(v.store().referrals, acquired, START, END)
    return rows.select(*REFERRAL_COLUMNS, *TAGS)


CLEAN = ["date", "day_of_week", "user_id", "keyword", "campaign_id", "ad_group_id", "device", "match_type"]


def _cleaned(v: Views, channel) -> DataFrame:
    conversions = attribution.one_conversion_per_user(
        event_source.channel_conversions(v.events(), channel, START, END)
    )
    if channel is BING:
        conversions = attribution.attach_keyword_name(conversions, attribution.keyword_lookup(v.bing_keywords()))
    sold = attribution.join_conversions(store_source.transactions_extract(v.store(), START, END), conversions)
    return attribution.clean_transactions(sold, channel, START, END)


def _cleaned_sql(source: str, keyword: str) -> str:
    return f"""SELECT CAST(date AS VARCHAR) AS date, dayname(date) AS day_of_week, user_id, keyword, campaign_id,
        ad_group_id, device, match_type, CAST(SUM(money) AS DOUBLE) AS money
    FROM (SELECT CAST(e.transaction_date AS DATE) AS date, c.app_user_id AS user_id, {keyword} AS keyword,
            c.campaign_id, c.ad_group_id, c.device, c.match_type, e.money_in_the_bank_paid_to_us AS money
        FROM extract e JOIN conv_one c ON e.app_user_id = c.app_user_id
            LEFT JOIN bing_words w ON c.keyword_id = w.keyword_id
        WHERE c.source = '{source}' AND CAST(e.transaction_date AS DATE) {WINDOW})
    GROUP BY ALL"""


@query("clean_transactions", _cleaned_sql("Google", "c.keyword"))
def _(v):
    return _cleaned(v, SEARCH).groupBy(*CLEAN).agg(F.sum("money_in_the_bank_paid_to_us").alias("money"))


@query("clean_transactions_bing", _cleaned_sql("Bing", "w.keyword"))
def _(v):
    return _cleaned(v, BING).groupBy(*CLEAN).agg(F.sum("money_in_the_bank_paid_to_us").alias("money"))


@query(
    "event_log_union",
    """SELECT campaign_name, COUNT(*) AS n_rows, COUNT(keyword) AS n_keywords, COUNT(keyword_id) AS n_keyword_ids,
        COUNT(budget) AS n_budgets, CAST(SUM(cost) AS DOUBLE) AS cost
    FROM (SELECT campaign_name, keyword, NULL AS keyword_id, NULL AS budget, cost FROM kw
        UNION ALL SELECT campaign_name, keyword, keyword_id, NULL, cost FROM bing_kw
        UNION ALL SELECT campaign_name, NULL, NULL, budget, cost FROM camp) GROUP BY campaign_name""",
)
def _(v):
    spend = attribution.event_log_union(v.search_keywords(), v.bing_keywords(), v.campaigns())
    return spend.groupBy("campaign_name").agg(
        F.count("*").alias("n_rows"),
        F.count("keyword").alias("n_keywords"),
        F.count("keyword_id").alias("n_keyword_ids"),
        F.count("budget").alias("n_budgets"),
        F.sum("cost").alias("cost"),
    )


@query(
    "unpivot_metrics",
    """SELECT keyword, type, value FROM (
        SELECT keyword, 'cost' AS type, CAST(SUM(cost) AS DOUBLE) AS value FROM kw GROUP BY keyword
        UNION ALL SELECT keyword, 'clicks', CAST(SUM(clicks) AS DOUBLE) FROM kw GROUP BY keyword
        UNION ALL SELECT keyword, 'impressions', CAST(SUM(impressions) AS DOUBLE) FROM kw GROUP BY keyword)""",
)
def _(v):
    wide = (
        v.search_keywords()
        .groupBy("keyword")
        .agg(*[F.sum(name).cast("double").alias(name) for name in ("cost", "clicks", "impressions")])
    )
    return series.unpivot_metrics(wide, ["keyword"], ["cost", "clicks", "impressions"])


@query(
    "earning_keywords_only",
    f"SELECT keyword, COUNT(*) AS n_rows FROM log_search WHERE {earning('log_search')} GROUP BY keyword",
)
def _(v):
    return counted(series.earning_keywords_only(v.search_log()), F.col("keyword"))


# Event logs ------------------------------------------------------------------------------------------------


@query("search_event_log", shown(LOG_COLUMNS, "log_search"))
def _(v):
    return v.search_log().select(LOG_COLUMNS)


@query("bing_event_log", shown(BING_LOG_COLUMNS, "log_bing"))
def _(v):
    return v.bing_log().select(BING_LOG_COLUMNS)


DISPLAY_LOG_COLUMNS = [name for name in LOG_COLUMNS]


@query("display_event_log", shown(DISPLAY_LOG_COLUMNS, "log_display"))
def _(v):
    return v.display_log().select(DISPLAY_LOG_COLUMNS)


def increments(v: Views) -> list[Increment]:
    """All rows in three increments, the last of which brings early rows late."""
    store = v.store()
    orders = order_batches(store.transactions, "id", "created_at")
    referrals = order_batches(store.referrals, "influencer_id", "week_start")
    spend = order_batches(v.search_keywords(), "ad_group_id", "date")
    campaigns = order_batches(v.campaigns(), "campaign_id", "date")
    day = F.timestamp_seconds("time")
    number = F.regexp_extract("orderId", "([0-9]+)", 1).cast("long")
    events = [e.drop("__day", "__number") for e in order_batches(v.events().withColumns({"__day": day, "__number": number}), "__number", "__day")]
    found = []
    for transactions, referred, spent, named, happened in zip(orders, referrals, spend, campaigns, events, strict=True):
        items = store.transaction_items.join(transactions.select(F.col("id").alias("transaction_id")), "transaction_id", "left_semi")
        part = store_source.Store(transactions, items, store.discounts, store.users, referred)
        found.append(Increment(spent, named, happened, part))
    return found


@query("event_log_refresh", shown(LOG_COLUMNS, "log_search"))
def _(v):
    kept = KeptLog(v.spark, sinks.new_folder(v.spark, "kept-log"), START, END, buckets=8)
    for i, increment in enumerate(increments(v)):
        kept.refresh(f"increment-{i}", increment)
    return kept.log().select(LOG_COLUMNS)


SOLD_ONLY = ["orderId", "latest_ad_utm_source", "latest_ad_utm_medium", "x_city"]
SPEND_ONLY = ["network", "est_search_impression_share_lost_rank"]
LOG_NAMES = {
    "search": LOG_COLUMNS + SOLD_ONLY + SPEND_ONLY + ["ad_group_name", "keyword_state", "landing_page_experience", "quality_score"],
    "bing": BING_LOG_COLUMNS + SOLD_ONLY + ["ad_group_name", "keyword_id", "keyword_state", "quality_score"],
    "display": LOG_COLUMNS + SOLD_ONLY + SPEND_ONLY + ["budget", "campaign_state", "est_search_impression_share_lost_budget"],
}


@query(
    "drop_tracking_columns",
    " UNION ALL ".join(
        f"""SELECT '{log}' AS log, unnest({sorted(names)}) AS column_name, n_rows FROM (SELECT COUNT(*) AS n_rows FROM log_{log})"""
        for log, names in LOG_NAMES.items()
    ),
)
def _(v):
    logs = {"search": v.search_log(), "bing": v.bing_log(), "display": v.display_log()}
    counts = [
        log.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("log"), F.explode(F.array(*[F.lit(column) for column in log.columns])).alias("column_name"), "n_rows"
        )
        for name, log in logs.items()
    ]
    return attribution.event_log_union(*counts)


# KPI reports -----------------------------------------------------------------------------------------------


@query("summarize_elog", kpi("log_search", []))
def _(v):
    return kpis.summarize_elog(v.search_log())


@query("summarize_elog_bing", kpi("log_bing", [], share=False))
def _(v):
    return kpis.summarize_elog(v.bing_log(), channel=BING)


@query("keywords_report", kpi("log_search", ["keyword"]))
def _(v):
    return reports.keywords_report(v.search_log())


@query("keywords_report_bing", kpi("log_bing", ["keyword"], share=False))
def _(v):
    return reports.keywords_report(v.bing_log(), channel=BING)


MATCHTYPE_KEYS = ["keyword", "campaign_name", "match_type"]


@query("keyword_campaign_matchtype_report", kpi("log_search", MATCHTYPE_KEYS))
def _(v):
    return reports.keyword_campaign_matchtype_report(v.search_log())


@query("keyword_campaign_matchtype_report_bing", kpi("log_bing", MATCHTYPE_KEYS, share=False))
def _(v):
    return reports.keyword_campaign_matchtype_report(v.bing_log(), channel=BING)


def _contribution_sql(log: str, share: bool) -> str:
    return f"""SELECT campaign_name, keyword, match_type, cost AS total_cost, contribution AS total_contribution,
        clicks AS total_clicks, contribution / NULLIF(clicks, 0) AS contribution_per_click,
        contribution / NULLIF(clicks, 0) / 2 AS "cpc_bid_for_2x_ROAS"
    FROM ({kpi(log, MATCHTYPE_KEYS, share)}) WHERE cost > 0 AND earnings > 0"""


@query("contribution_per_click", _contribution_sql("log_search", True))
def _(v):
    return reports.contribution_per_click(v.search_log())


@query("contribution_per_click_bing", _contribution_sql("log_bing", False))
def _(v):
    return reports.contribution_per_click(v.bing_log(), channel=BING)


@query("campaign_lookup", "SELECT * FROM camp_names")
def _(v):
    return attribution.campaign_lookup(v.campaigns())


@query("keyword_lookup", "SELECT * FROM bing_words")
def _(v):
    return attribution.keyword_lookup(v.bing_keywords())


def _users_sql(log: str) -> str:
    return f"""SELECT *, earnings * 0.25 AS contribution, referred_earnings * 0.25 AS referred_contribution,
        earnings + referred_earnings AS total_earnings,
        earnings * 0.25 + referred_earnings * 0.25 AS total_contribution
    FROM (SELECT user_id, MAX(user_name) AS name, COUNT(*) AS num_transactions,
            CAST(COALESCE(SUM(money_in_the_bank_paid_to_us), 0) AS DOUBLE) AS earnings,
            MAX(campaign_name) AS campaign_name, MAX(keyword) AS keyword,
            CAST(COALESCE(SUM(new_referred_users), 0) AS BIGINT) AS referred_users,
            CAST(COALESCE(SUM(referred_users_transaction_amount), 0) AS DOUBLE) AS referred_earnings
        FROM {log} WHERE user_id IS NOT NULL GROUP BY user_id)"""


@query("user_overview", _users_sql("log_search"))
def _(v):
    return reports.user_overview(v.search_log())


@query("user_overview_bing", _users_sql("log_bing"))
def _(v):
    return reports.user_overview(v.bing_log())


def _customers_sql(log: str) -> str:
    return f"""SELECT strftime(first_week, '%Y-%m') AS first_transaction_month,
        COUNT(DISTINCT user_id) AS num_acquisitions
    FROM (SELECT user_id, MIN(week) AS first_week FROM {log} WHERE user_id IS NOT NULL GROUP BY user_id)
    GROUP BY 1"""


@query("customers_per_month", _customers_sql("log_search"))
def _(v):
    return reports.customers_per_month(v.search_log())


@query("customers_per_month_bing", _customers_sql("log_bing"))
def _(v):
    return reports.customers_per_month(v.bing_log())


TOTAL_CUSTOMERS_SQL = f"""SELECT first_transaction_month,
    COALESCE(s.num_acquisitions, 0) AS num_acquisitions_search,
    COALESCE(b.num_acquisitions, 0) AS num_acquisitions_bing,
    COALESCE(s.num_acquisitions, 0) + COALESCE(b.num_acquisitions, 0) AS total_acquisitions
FROM ({_customers_sql("log_search")}) s FULL JOIN ({_customers_sql("log_bing")}) b USING (first_transaction_month)"""


@query("total_customers_per_month", TOTAL_CUSTOMERS_SQL)
def _(v):
    return reports.total_customers_per_month(
        reports.customers_per_month(v.search_log()), reports.customers_per_month(v.bing_log())
    )


def _orders_sql(log: str, where: str = "TRUE") -> str:
    return f"""SELECT week, campaign_name, CAST(COALESCE(SUM(cost), 0) AS DOUBLE) AS cost,
        CAST(COALESCE(SUM(money_in_the_bank_paid_to_us), 0) AS DOUBLE) * 0.25 AS contribution,
        COUNT(DISTINCT user_name) AS num_orders FROM {log} WHERE {where} GROUP BY week, campaign_name"""


@query("orders_per_week", dated(_orders_sql("log_search")))
def _(v):
    return reports.orders_per_week(v.search_log())


@query("orders_per_week_bing", dated(_orders_sql("log_bing")))
def _(v):
    return reports.orders_per_week(v.bing_log())


@query("weekly_conversion_metrics", dated(METRICS_SQL))
def _(v):
    return reports.weekly_conversion_metrics(v.search_log(), CAMPAIGN_PATTERN)


BING_METRICS_SQL = f"""SELECT {", ".join(BING_METRICS)}
FROM ({kpi("log_bing", ["keyword", "campaign_name", "week"], share=False)})"""


@query("weekly_conversion_metrics_bing", dated(BING_METRICS_SQL))
def _(v):
    return reports.weekly_conversion_metrics(v.bing_log(), channel=BING)


@query("keywords_with_earnings", f"SELECT * FROM ({kpi('log_search', ['keyword'])}) WHERE earnings > 0")
def _(v):
    return reports.keywords_with_earnings(v.search_log())


@query(
    "keywords_with_earnings_bing",
    f"SELECT * FROM ({kpi('log_bing', ['keyword'], share=False)}) WHERE earnings > 0",
)
def _(v):
    return reports.keywords_with_earnings(v.bing_log(), channel=BING)


# Several grains from one pass ------------------------------------------------------------------------------

USER_GRAINS = {"total": [], "keyword": ["keyword"], "campaign": ["campaign_name"], "keyword_week": ["keyword", "campaign_name", "week"]}
KPI_GRAINS = {
    "total": [],
    "keyword": ["keyword"],
    "match_type": MATCHTYPE_KEYS,
    "week": ["keyword", "campaign_name", "week"],
}


def _grains_sql(grains: dict[str, list[str]], body: Callable[[list[str]], str]) -> str:
    """All grains below each other; keys that a grain lacks are NULL."""
    every = list(dict.fromkeys(key for keys in grains.values() for key in keys))

    def cell(key: str, keys: list[str]) -> str:
        value = f"CAST({key} AS VARCHAR)" if key in keys else "CAST(NULL AS VARCHAR)"
        return f"{value} AS {key}"

    return " UNION ALL ".join(
        f"""SELECT '{grain}' AS grain, {", ".join(cell(key, keys) for key in every)}, x.* {f"EXCLUDE ({', '.join(keys)})" if keys else ""}
        FROM ({body(keys)}) x"""
        for grain, keys in grains.items()
    )


def _users_by(keys: list[str]) -> str:
    lead = "".join(f"{key}, " for key in keys)
    return f"SELECT {lead}COUNT(DISTINCT user_id) AS num_acquisitions FROM log_search {f'GROUP BY {lead[:-2]}' if keys else ''}"


@query("acquisitions_rollup", _grains_sql(USER_GRAINS, _users_by))
def _(v):
    return rollups.acquisitions_rollup(v.search_log(), USER_GRAINS)


@query("kpi_grouping_sets", _grains_sql(KPI_GRAINS, lambda keys: kpi("log_search", keys)))
def _(v):
    return rollups.kpi_rollup(v.search_log(), KPI_GRAINS)


@query("kpi_grouping_sets_bing", _grains_sql(KPI_GRAINS, lambda keys: kpi("log_bing", keys, share=False)))
def _(v):
    return rollups.kpi_rollup(v.bing_log(), KPI_GRAINS, channel=BING)


# Series ----------------------------------------------------------------------------------------------------


def _overall_sql(log: str) -> str:
    return f"SELECT week, type, value FROM ({sql.series(log, [], roi='cum_ROAS')})"


@query("overall_performance_over_time", dated(_overall_sql("log_search")))
def _(v):
    return series.overall_performance_over_time(v.search_log())


@query("overall_performance_over_time_bing", dated(_overall_sql("log_bing")))
def _(v):
    return series.overall_performance_over_time(v.bing_log())


@query("overall_performance_over_time_display", dated(_overall_sql("log_display")))
def _(v):
    return series.overall_performance_over_time(v.display_log())


@query(
    "keywords_performance_over_time",
    dated(sql.series("log_search", ["keyword"], where=earning("log_search"))),
)
def _(v):
    return series.keywords_performance_over_time(v.search_log())


@query(
    "series_resumed",
    dated(sql.series("log_search", ["keyword"], where=earning("log_search"))),
)
def _(v):
    log = sinks.materialize(v.search_log(), "series-log")
    kept = KeptSeries(v.spark, sinks.new_folder(v.spark, "series"), ["keyword"])
    week = F.coalesce(F.col("week").cast("string"), F.lit("9999"))
    late = (week >= "2000-01-01") & (F.coalesce("campaign_id", F.lit(0)) % 10 == 0)
    for part in (~late & (week < "2001-06-01"), ~late & (week >= "2001-06-01"), late):
        kept.add(log.filter(part))
    return kept.rows()


@query(
    "keywords_performance_over_time_bing",
    dated(sql.series("log_bing", ["keyword"], where=earning("log_bing"))),
)
def _(v):
    return series.keywords_performance_over_time(v.bing_log())


@query(
    "keywords_campaign_performance_over_time",
    dated(sql.series("log_search", ["keyword", "campaign_name"], where=earning("log_search"))),
)
def _(v):
    return series.keywords_campaign_performance_over_time(v.search_log())


@query(
    "keywords_campaign_performance_over_time_bing",
    dated(sql.series("log_bing", ["keyword", "campaign_name"], where=earning("log_bing"))),
)
def _(v):
    return series.keywords_campaign_performance_over_time(v.bing_log())


@query("device_performance_over_time", dated(sql.series("log_search", DEVICE_KEYS)))
def _(v):
    return series.device_performance_over_time(v.search_log())


@query("device_performance_over_time_bing", dated(sql.series("log_bing", DEVICE_KEYS)))
def _(v):
    return series.device_performance_over_time(v.bing_log())


@query("display_device_performance", dated(sql.series("log_display", ["device"])))
def _(v):
    return series.display_device_performance(v.display_log())


# Cohorts ---------------------------------------------------------------------------------------------------


@query("week_ordinal", dated("SELECT week, week_number FROM cohort_ordinals"))
def _(v):
    return cohorts.week_ordinal(v.search_log(), COHORT_KEYWORD)


@query(
    "cohort_assignment",
    dated("""SELECT week, week_number, cohort_week, 'cohort_' || cohort_week AS cohort, user_id, COUNT(*) AS n_rows
    FROM cohorts GROUP BY ALL"""),
)
def _(v):
    rows = cohorts.cohort_assignment(v.search_log(), COHORT_KEYWORD)
    return counted(rows, *[F.col(c) for c in ("week", "week_number", "cohort_week", "cohort", "user_id")])


def _cohort_totals_sql(rows: str) -> str:
    sums = f"""SELECT cohort_week, CAST(COALESCE(SUM(cost), 0) AS DOUBLE) AS spent,
        CAST(COALESCE(SUM(money_in_the_bank_paid_to_us), 0) AS DOUBLE) * 0.25 AS contribution
    FROM {rows} GROUP BY cohort_week"""
    return f"""
        SELECT cohort_week, 'cohort_cost' AS type, -spent AS value, contribution - spent AS "cohort_ROI" FROM ({sums})
        UNION ALL SELECT cohort_week, 'cohort_contribution', contribution, contribution - spent FROM ({sums})"""


@query("cohort_totals", _cohort_totals_sql("cohorts"))
def _(v):
    return cohorts.cohort_totals(v.search_log(), COHORT_KEYWORD)


@query(
    "cohort_roi_merge",
    """SELECT cohort_week, type, value, "cohort_ROI" FROM (
        SELECT campaign_id AS cohort_week, 'cohort_cost' AS type, -CAST(SUM(cost) AS DOUBLE) AS value,
            CAST(SUM(clicks) AS DOUBLE) AS "cohort_ROI" FROM kw GROUP BY campaign_id
        UNION ALL SELECT campaign_id, 'cohort_contribution', CAST(SUM(impressions) AS DOUBLE),
            CAST(SUM(clicks) AS DOUBLE) FROM kw GROUP BY campaign_id)""",
)
def _(v):
    totals = (
        v.search_keywords()
        .groupBy(F.col("campaign_id").alias("cohort_week"))
        .agg(
            (-F.sum("cost").cast("double")).alias("cohort_cost"),
            F.sum("impressions").cast("double").alias("cohort_contribution"),
            F.sum("clicks").cast("double").alias("cohort_ROI"),
        )
    )
    return cohorts.cohort_roi_merge(totals)


def _cohort_series_sql(rows: str) -> str:
    return sql.series(rows, ["cohort_week"], order="week_number")


@query("cohort_performance_over_time", _cohort_series_sql("cohorts"))
def _(v):
    return cohorts.cohort_performance_over_time(v.search_log(), COHORT_KEYWORD)


def _breakeven_sql(rows: str) -> str:
    return f"""SELECT cohort_week, week_number, cost, contribution, type, value, breakeven_week,
        MIN(CASE WHEN breakeven_week = 1 THEN week_number END) OVER (PARTITION BY cohort_week)
            - MIN(week_number) OVER (PARTITION BY cohort_week) + 1 AS weeks_until_breakeven
    FROM (SELECT *, CAST(CASE WHEN value > 0 AND (before IS NULL OR before < 0) THEN 1 ELSE 0 END AS BIGINT)
            AS breakeven_week
        FROM (SELECT *, lag(value) OVER (PARTITION BY cohort_week ORDER BY week_number) AS before
            FROM ({_cohort_series_sql(rows)}) WHERE type = 'cum_ROI'))"""


@query("cohort_breakeven", _breakeven_sql("cohorts"))
def _(v):
    return cohorts.cohort_breakeven(v.search_log(), COHORT_KEYWORD)


@query("cohort_breakeven_bing", _breakeven_sql("cohorts_bing"))
def _(v):
    return cohorts.cohort_breakeven(v.bing_log(), COHORT_KEYWORD)


# Sink and job ----------------------------------------------------------------------------------------------


@query("write_report_csv", kpi("log_search", ["keyword"]))
def _(v):
    report = reports.keywords_report(v.search_log())
    path = sinks.new_folder(v.spark, "csv")
    sinks.write_report_csv(report, path)
    return sinks.read_report_csv(v.spark, path, report.schema)


# Columns of the reports that are no numbers.
WORDS = ["campaign_name", "device", "first_transaction_month", "keyword", "match_type", "name", "type", "week"]


def values_sql(label: str, bodies: dict[str, str]) -> str:
    """Rows of each frame, and the sum of all its numbers, each in whole hundredths."""
    words = ", ".join(f"'{word}'" for word in WORDS)
    hundredths = f"list_transform([*COLUMNS(lambda c: c NOT IN ({words}))], lambda x: CAST(round(x * 100) AS HUGEINT))"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS {label}, COUNT(*) AS n_rows, CAST(COALESCE(SUM(list_sum({hundredths})), 0) AS DOUBLE) AS hundredths
        FROM (SELECT * FROM ({body}))"""
        for name, body in bodies.items()
    )


def values_of(label: str, frames: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, frame: DataFrame) -> DataFrame:
        numbers = [F.col(f.name) for f in frame.schema if isinstance(f.dataType, T.NumericType)]
        cells = [F.coalesce(F.round(number.cast("double") * 100).cast("decimal(38,0)"), F.lit(0)) for number in numbers]
        sums = [F.coalesce(F.sum(cell), F.lit(0)) for cell in cells]
        total = reduce(lambda a, b: a + b, sums).cast("double")
        return frame.agg(F.count("*").alias("n_rows"), total.alias("hundredths")).select(F.lit(name).alias(label), "n_rows", "hundredths")

    return attribution.event_log_union(*[one(name, frame) for name, frame in frames.items()])


def _report_counts_sql() -> str:
    word = f"keyword = '{COHORT_KEYWORD}'"
    counts: dict[str, str] = {"total_customers_per_month": TOTAL_CUSTOMERS_SQL}
    for channel, log, cohort, share in (
        ("search", "log_search", "cohorts", True),
        ("bing", "log_bing", "cohorts_bing", False),
    ):
        campaign = f"regexp_matches(campaign_name, '{CAMPAIGN_PATTERN}')" if share else "TRUE"
        by_device = sql.series(log, DEVICE_KEYS, where=word)
        counts |= {
            f"{channel}/user_overview": _users_sql(log),
            f"{channel}/keyword_campaign_matchtype_report": kpi(log, MATCHTYPE_KEYS, share),
            f"{channel}/contribution_per_click": _contribution_sql(log, share),
            f"{channel}/orders_per_week": _orders_sql(log, f"{word} AND {campaign}"),
            f"{channel}/customers_per_month": _customers_sql(log),
            f"{channel}/overall_performance_over_time": _overall_sql(log),
            f"{channel}/keywords_performance_over_time": sql.series(log, ["keyword"], where=earning(log)),
            f"{channel}/keywords_campaign_performance_over_time": sql.series(
                log, ["keyword", "campaign_name"], where=earning(log)
            ),
            f"{channel}/mobile_performance_over_time": by_device,
            f"{channel}/desktop_performance_over_time": by_device,
            f"{channel}/cohort_totals": _cohort_totals_sql(cohort),
            f"{channel}/cohort_performance_over_time": _cohort_series_sql(cohort),
            f"{channel}/cohort_breakeven": _breakeven_sql(cohort),
        }
    counts |= {
        "search/impression_share_over_time": METRICS_SQL,
        "search/click_through_rate_over_time": METRICS_SQL,
        "display/overall_performance_over_time": _overall_sql("log_display"),
        "display/desktop_performance_over_time": sql.series("log_display", ["device"]),
        "display/mobile_performance_over_time": sql.series("log_display", ["device"]),
        "display/orders_per_week": _orders_sql("log_display"),
    }
    return values_sql("report", counts)


@query("marketing_report", _report_counts_sql())
def _(v):
    logs = event_logs(v.sources(), START, END, lambda rows: sinks.materialize(rows, "sold"))
    found = marketing_report(logs.search, logs.bing, logs.display, focus=FOCUS)
    return values_of("report", found)


DISPLAY_REPORTS = {
    "display/overall_performance_over_time": _overall_sql("log_display"),
    "display/desktop_performance_over_time": sql.series("log_display", ["device"]),
    "display/mobile_performance_over_time": sql.series("log_display", ["device"]),
    "display/orders_per_week": _orders_sql("log_display"),
}


@query("published_reports", values_sql("report", DISPLAY_REPORTS))
def _(v):
    root = sinks.new_folder(v.spark, "published")
    found = marketing_report(display=v.display_log(), focus=FOCUS)
    publish_reports({name: frame.limit(1) for name, frame in found.items()}, root)  # an older version, which is replaced
    publish_reports(found, root)
    return values_of("report", published_reports(v.spark, root))


@query(
    "chart_frames",
    values_sql(
        "chart",
        {
            "search/click_through_rate_over_time": RECENT_SQL,
            "search/impression_share_over_time": RECENT_SQL,
            "search/mobile_performance_over_time": sql.series(
                "log_search", DEVICE_KEYS, where=f"keyword = '{COHORT_KEYWORD}' AND device = 'mb'"
            ),
            "search/desktop_performance_over_time": sql.series(
                "log_search",
                DEVICE_KEYS,
                where=f"keyword = '{COHORT_KEYWORD}' AND device = 'dt' AND {earning('log_search')}",
            ),
            "bing/click_through_rate_over_time": f"""SELECT * FROM ({BING_METRICS_SQL}) WHERE keyword = '{COHORT_KEYWORD}'
                AND week BETWEEN DATE '{AS_OF}' - 28 AND DATE '{AS_OF}'""",
            "bing/mobile_performance_over_time": sql.series(
                "log_bing", DEVICE_KEYS, where=f"keyword = '{COHORT_KEYWORD}' AND device = 'mb' AND {earning('log_bing')}"
            ),
            "bing/desktop_performance_over_time": sql.series(
                "log_bing", DEVICE_KEYS, where=f"keyword = '{COHORT_KEYWORD}' AND device = 'dt' AND {earning('log_bing')}"
            ),
            "display/mobile_performance_over_time": sql.series("log_display", ["device"], where="device = 'mb'"),
            "display/desktop_performance_over_time": sql.series("log_display", ["device"], where="device = 'dt'"),
        },
    ),
)
def _(v):
    search, bing, display = v.search_log(), v.bing_log(), v.display_log()
    whole = {
        "bing/click_through_rate_over_time": reports.weekly_conversion_metrics(bing, channel=BING),
        "search/click_through_rate_over_time": reports.weekly_conversion_metrics(search, CAMPAIGN_PATTERN),
        "display/mobile_performance_over_time": series.display_device_performance(display),
        "display/desktop_performance_over_time": series.display_device_performance(display),
    }
    charts = chart_frames(whole, {"search": search, "bing": bing, "display": display}, FOCUS, AS_OF)
    return values_of("chart", charts)
