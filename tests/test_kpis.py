"""The KPI summary against known totals and hand-made rows."""

import datetime as dt

import pytest

from adlog.channels import BING
from adlog.operators import filters, reports, series
from adlog.operators.kpis import summarize_elog

ELOG = """date date, week date, keyword string, campaign_name string, match_type string, device string,
    cost decimal(18,2), impressions long, clicks long, average_position double,
    est_search_impression_share double, user_id long, user_name string,
    money_in_the_bank_paid_to_us decimal(18,2), new_referred_users long,
    referred_users_transaction_amount decimal(18,2)"""


def elog(spark, *events):
    """Event-log rows; what a row does not name is NULL."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(ELOG)
    fields = [field.name for field in schema]
    return spark.createDataFrame([tuple(event.get(name) for name in fields) for event in events], schema)


def money(text):
    from decimal import Decimal

    return Decimal(text)


@pytest.fixture
def known(spark):
    spend = [
        dict(cost=money("30.00"), impressions=700, clicks=9, average_position=4.12, est_search_impression_share=700 / 1935.085),
        dict(cost=money("5.67"), impressions=5, clicks=2, average_position=3.96, est_search_impression_share=0.5),
    ]
    orders = [dict(user_id=i, user_name=f"u{i}", money_in_the_bank_paid_to_us=money("100.00")) for i in range(14)]
    orders.append(dict(user_id=0, user_name="u0", money_in_the_bank_paid_to_us=money("115.83")))
    return elog(spark, *spend, *orders)


GOLDEN = {
    "cost": 35.67,
    "average_position": 4.118865,
    "estimated_available_impressions": 1945.085,
    "impressions": 705,
    "est_search_impression_share": 0.362452,
    "clicks": 11,
    "click_through_rate": 0.01560284,
    "num_acquisitions": 14,
    "conversion_rate": 1.272727,
    "cost_per_click": 3.242727,
    "earnings": 1515.83,
    "contribution": 378.9575,
    "earnings_per_click": 137.8027,
    "contribution_per_click": 34.45068,
    "cpa": 2.547857,
    "referred_users": 0,
    "referred_earnings": 0,
    "estimated_ltv": 2450,
    "estimated_lifetime_ROAS": 67.68517,
    "total_earnings": 1515.83,
    "total_contribution": 378.9575,
    "actual_ROAS": 9.623984,
}


def test_known_totals(known):
    row = summarize_elog(known).head().asDict()
    assert row == {name: pytest.approx(value, rel=1e-6) for name, value in GOLDEN.items()}


def test_second_engine_has_no_impression_share(known):
    row = summarize_elog(known, channel=BING).head().asDict()
    share = {"estimated_available_impressions", "est_search_impression_share"}
    assert row == {name: pytest.approx(value, rel=1e-6) for name, value in GOLDEN.items() if name not in share}


def test_parameters(known):
    row = summarize_elog(known, margin=0.5, orders_in_lifetime=2, value_per_order=10).head()
    assert row.estimated_ltv == 14 * 2 * 10 * 0.5
    assert row.contribution == pytest.approx(1515.83 * 0.5)


def test_referral_columns_may_be_absent(known):
    row = summarize_elog(known.drop("new_referred_users", "referred_users_transaction_amount")).head()
    assert (row.referred_users, row.referred_earnings, row.total_earnings, row.actual_ROAS) == (None, None, None, None)


def test_referrals_count(spark):
    log = elog(
        spark,
        dict(cost=money("10.00"), clicks=0, impressions=0),
        dict(user_id=1, money_in_the_bank_paid_to_us=money("20.00")),
        dict(user_id=2, new_referred_users=3, referred_users_transaction_amount=money("60.00")),
    )
    row = summarize_elog(log).head()
    assert (row.num_acquisitions, row.referred_users, row.referred_earnings) == (2, 3, 60.0)
    assert (row.total_earnings, row.total_contribution, row.actual_ROAS) == (80.0, 20.0, 1.0)
    assert (row.click_through_rate, row.cost_per_click, row.conversion_rate) == (None, None, None)


def test_cpa_without_buyers_is_the_cost(spark):
    row = summarize_elog(elog(spark, dict(cost=money("7.00"), clicks=1))).head()
    assert row.cpa == 7.0


def test_null_keyword_is_a_group_and_may_earn(spark):
    log = elog(
        spark,
        dict(keyword=None, user_id=1, money_in_the_bank_paid_to_us=money("5.00")),
        dict(keyword="a", user_id=2, money_in_the_bank_paid_to_us=money("0.00")),
        dict(keyword="b", user_id=2, money_in_the_bank_paid_to_us=money("1.00")),
    )
    assert {row.keyword for row in reports.keywords_report(log).collect()} == {None, "a", "b"}
    assert {row.keyword for row in reports.keywords_with_earnings(log).collect()} == {None, "b"}
    assert {row.keyword for row in series.earning_keywords_only(log).collect()} == {None, "b"}
    assert {row.keyword for row in series.keywords_performance_over_time(log.withColumn("week", log.date)).collect()} == {None, "b"}


def test_null_campaign_fails_the_pattern(spark):
    log = elog(spark, dict(campaign_name=None), dict(campaign_name="Rmktg x"), dict(campaign_name="Core"))
    assert [row.campaign_name for row in filters.filter_display_remarketing(log).collect()] == ["Rmktg x"]


def test_contribution_per_click(spark):
    log = elog(
        spark,
        dict(keyword="a", campaign_name="c", match_type="Exact", cost=money("10.00"), clicks=5),
        dict(keyword="a", campaign_name="c", match_type="Exact", user_id=1, money_in_the_bank_paid_to_us=money("80.00")),
        dict(keyword="free", campaign_name="c", match_type="Exact", user_id=1, money_in_the_bank_paid_to_us=money("80.00")),
        dict(keyword="idle", campaign_name="c", match_type="Exact", cost=money("10.00"), clicks=5),
    )
    assert [tuple(row) for row in reports.contribution_per_click(log).collect()] == [
        ("c", "a", "Exact", 10.0, 20.0, 5, 4.0, 2.0)
    ]


def test_customers_count_in_their_first_month(spark):
    day = dt.date
    log = elog(
        spark,
        dict(user_id=1, week=day(2016, 2, 1)),
        dict(user_id=1, week=day(2016, 1, 4)),
        dict(user_id=2, week=day(2016, 1, 25)),
        dict(user_id=3, week=day(2016, 2, 29)),
        dict(week=day(2015, 1, 5), cost=money("1.00")),
    )
    found = {tuple(row) for row in reports.customers_per_month(log).collect()}
    assert found == {("2016-01", 2), ("2016-02", 1)}


def test_total_customers_is_the_sum_of_both(spark):
    search = spark.createDataFrame([("2016-01", 2), ("2016-02", 1)], "first_transaction_month string, num_acquisitions long")
    bing = spark.createDataFrame([("2016-02", 4), ("2016-03", 5)], search.schema)
    found = {tuple(row) for row in reports.total_customers_per_month(search, bing).collect()}
    assert found == {("2016-01", 2, 0, 2), ("2016-02", 1, 4, 5), ("2016-03", 0, 5, 5)}


def test_user_overview_counts_every_row(spark):
    log = elog(
        spark,
        dict(user_id=1, user_name="Ann", keyword="k", campaign_name="c", money_in_the_bank_paid_to_us=money("10.00")),
        dict(user_id=1, user_name="Ann", keyword="k", campaign_name="c", money_in_the_bank_paid_to_us=money("0.10")),
        dict(user_id=1, keyword="k", campaign_name="c", new_referred_users=2, referred_users_transaction_amount=money("4.00")),
        dict(cost=money("1.00")),
    )
    assert [tuple(row) for row in reports.user_overview(log).collect()] == [
        (1, "Ann", 3, 10.1, 2.525, "c", "k", 2, 4.0, 1.0, 14.1, 3.525)
    ]


def test_recent_weeks_and_date_filter_bounds(spark):
    weeks = [dt.date(2016, 1, 4) + dt.timedelta(weeks=i) for i in range(8)]
    log = elog(spark, *[dict(week=week, date=week, keyword="k") for week in weeks])
    kept = {row.week for row in filters.recent_weeks(log, weeks[5], "k").collect()}
    assert kept == set(weeks[1:6])
    assert {row.date for row in filters.date_filter(log, weeks[2], "2016-02-01 23:00:00").collect()} == set(weeks[2:5])


def test_date_filter_defaults_to_today(spark):
    today = dt.date.today()
    log = elog(spark, dict(date=today), dict(date=today - dt.timedelta(days=400)), dict(date=today + dt.timedelta(days=400)))
    assert [row.date for row in filters.date_filter(log).collect()] == [today]


def test_large_sums_do_not_depend_on_tasks(spark):
    """Beyond 1e10 available impressions every digit stays the same, however the rows are dealt out."""
    rows_ = spark.range(30_000).selectExpr(
        "cast(null AS date) AS date", "'k' AS keyword", "cast(id % 7 + 1 AS double) / 3 AS average_position",
        "(id * 7919 % 1000003) * 1000 AS impressions", "(id % 97 + 1) / 100D AS est_search_impression_share", "1L AS clicks",
        "cast(1 AS decimal(18,2)) AS cost", "cast(null AS bigint) AS user_id", "cast(null AS decimal(18,2)) AS money_in_the_bank_paid_to_us",
    )
    found = {
        tuple(summarize_elog(rows_.repartition(n), "keyword").select("estimated_available_impressions", "average_position").first())
        for n in (1, 3, 7)
    }
    assert len(found) == 1
    available = found.pop()[0]
    exact = sum(round((i * 7919 % 1000003) * 1000 / ((i % 97 + 1) / 100), 6) for i in range(30_000))
    assert available > 1e10 and available == pytest.approx(exact, rel=1e-12)
