"""What an event log holds, on a small hand-made store."""

import datetime as dt
from decimal import Decimal

import pytest

from adlog import schemas
from adlog.operators.kpis import summarize_elog
from adlog.operators.reports import user_overview
from adlog.plans.event_logs import bing_event_log, display_event_log, search_event_log
from adlog.sources.sinks import materialize
from conftest import rows
from test_sources import at, make_store

START, END = "2016-05-01", "2016-05-31"


def spend(spark, kind):
    columns = {"date": "date", "campaign_id": "long", "campaign_name": "string", "device": "string", "cost": "decimal(18,2)",
               "impressions": "long", "clicks": "long", "average_position": "double"}
    base = (Decimal("3.00"), 100, 5, 2.0)
    data = [
        (dt.date(2016, 5, 1), 1, "Core one", "dt", *base),
        (dt.date(2016, 5, 2), 2, "Rmktg two", "mb", *base),
    ]
    frame = spark.createDataFrame(data, ", ".join(f"{name} {kind}" for name, kind in columns.items()))
    if kind == "campaign":
        return frame.selectExpr("*", "0.5D AS est_search_impression_share", "cast(9 AS decimal(18,2)) AS budget")
    frame = frame.selectExpr("*", "concat('word ', campaign_id) AS keyword", "'Exact' AS match_type")
    if kind == "bing":
        return frame.selectExpr("*", "campaign_id + 10 AS keyword_id")
    return frame.selectExpr("*", "0.5D AS est_search_impression_share")


EVENT_COLUMNS = """event string, time long, distinct_id string, id string, orderId string, latest_ad_utm_source string,
    latest_ad_utm_medium string, latest_ad_utm_campaign string, latest_ad_awkeyword string, latest_ad_awadgroupid string,
    latest_ad_awmatchtype string, latest_ad_device string, x_email string, x_city string"""


def make_events(spark):
    second = int(dt.datetime(2016, 5, 3, tzinfo=dt.UTC).timestamp())

    def event(user, order, after, source, campaign, word):
        return ("Completed Order", second + after, "d", user, order, source, "cpc", campaign, word, "4", "e", "mb", "a@b", "Oslo")

    return spark.createDataFrame(
        [
            event("1", "o1", 10, "Google", "1", "+Word  +A"),
            event("1", "o2", 20, "Google", "2", "+Late"),
            event("2", "o3", 0, "Google", "2", "+Word  +B"),
            event("3", "o4", 0, "Google", "1", "+Old"),
            event("4", "o5", 0, "Google", "77", "+Unknown"),
            event("5", "o6", 0, "Google", "1", "+No order"),
            event("1", "o7", 0, "Bing", "1", "kwd-11"),
        ],
        EVENT_COLUMNS,
    )


@pytest.fixture
def tables(spark):
    return make_store(
        spark,
        transactions=[
            (1, 1, at(1), True, False, 0, 0, 0),
            (2, 1, at(20), True, False, 0, 0, 0),
            (3, 2, at(9), True, False, 0, 0, 0),
            (4, 3, dt.datetime(2016, 4, 1), False, False, 0, 0, 0),
            (5, 3, at(9), True, False, 0, 0, 0),
            (6, 4, at(9), True, False, 0, 0, 0),
            (7, 6, at(9), True, False, 0, 0, 0),
            (8, 1, dt.datetime(2016, 6, 1), True, False, 0, 0, 0),
        ],
        items=[(1, None, 10, False), (1, None, 11, False), (2, None, 12, False), (3, None, 13, False), (5, None, 14, False),
               (6, None, 15, False), (7, None, 16, False), (8, None, 17, False)],
        users=[(i, f"User {i}") for i in range(1, 7)],
        referrals=[
            (1, dt.date(2016, 5, 9), 2, 30),
            (1, dt.date(2016, 4, 25), 9, 90),
            (2, dt.date(2016, 5, 16), 1, 5),
            (5, dt.date(2016, 5, 9), 1, 5),
            (6, dt.date(2016, 5, 9), 1, 5),
        ],
    )


def search_log(spark, tables, stage=None):
    return search_event_log(spend(spark, "search"), spend(spark, "campaign"), make_events(spark), tables, START, END, stage)


def test_transactions_of_new_customers(spark, tables):
    log = search_log(spark, tables)
    found = log.filter("money_in_the_bank_paid_to_us is not null")
    may = dt.date(2016, 5, 1).replace
    assert rows(found, "user_id", "date", "week", "keyword", "campaign_name", "device", "match_type") == [
        # Every transaction of a user carries the first conversion, also one made before it. A user whose first
        # order lies before the window (3) or who did not convert (6) is out, and so is an order after the window.
        (1, may(day=1), may(day=2), "word a", "Core one", "mb", "Exact"),
        (1, may(day=1), may(day=2), "word a", "Core one", "mb", "Exact"),
        (1, may(day=20), may(day=16), "word a", "Core one", "mb", "Exact"),
        (2, may(day=9), may(day=9), "word b", "Rmktg two", "mb", "Exact"),
        (4, may(day=9), may(day=9), "unknown", None, "mb", "Exact"),
    ]


def test_referrals_follow_users_who_bought(spark, tables):
    found = search_log(spark, tables).filter("new_referred_users is not null")
    assert rows(found, "user_id", "week", "date", "keyword", "campaign_id", "new_referred_users", "user_name", "cost") == [
        (1, dt.date(2016, 5, 9), None, "word a", 1, 2, None, None),
        (2, dt.date(2016, 5, 16), None, "word b", 2, 1, None, None),
    ]


def test_spend_rows_stay_whole(spark, tables):
    found = search_log(spark, tables).filter("cost is not null")
    assert rows(found, "date", "week", "keyword", "user_id", "clicks") == [
        (dt.date(2016, 5, 1), dt.date(2016, 5, 2), "word 1", None, 5),
        (dt.date(2016, 5, 2), dt.date(2016, 5, 2), "word 2", None, 5),
    ]


def test_log_is_the_sum_of_its_parts(spark, tables):
    assert search_log(spark, tables).count() == 5 + 2 + 2


def test_personal_and_tracking_columns_are_gone(spark, tables):
    columns = set(search_log(spark, tables).columns)
    assert not columns & set(schemas.TRACKING_COLUMNS)
    assert {"x_city", "orderId", "purchase_type"} <= columns


def test_referral_rows_count_as_acquisitions(spark, tables):
    log = search_log(spark, tables)
    assert summarize_elog(log).head().num_acquisitions == 3
    counts = {row.user_id: row.num_transactions for row in user_overview(log).collect()}
    assert counts == {1: 4, 2: 2, 4: 1}


def test_display_log_keeps_remarketing_only(spark, tables):
    log = display_event_log(spend(spark, "campaign"), make_events(spark), tables, START, END)
    assert rows(log, "campaign_name", "user_id", "keyword", "new_referred_users") == [
        ("Rmktg two", 2, "word b", 1),
        ("Rmktg two", 2, "word b", None),
        ("Rmktg two", None, None, None),
    ]


def test_bing_log_looks_up_keywords(spark, tables):
    log = bing_event_log(spend(spark, "bing"), make_events(spark), tables, START, END)
    bought = log.filter("money_in_the_bank_paid_to_us is not null")
    assert rows(bought, "user_id", "keyword", "campaign_name", "ad_group_id") == [(1, "word 1", "Core one", 4)] * 3
    assert "est_search_impression_share" not in log.columns


def test_staged_log_is_the_same(spark, tables):
    columns = ["user_id", "week", "keyword", "campaign_name", "cost", "money_in_the_bank_paid_to_us", "new_referred_users"]
    staged = search_log(spark, tables, lambda frame: materialize(frame, "sold"))
    assert rows(staged, *columns) == rows(search_log(spark, tables), *columns)


def test_nothing_personal_is_staged(spark, tables):
    staged = []

    def stage(frame):
        staged.append(frame.columns)
        return materialize(frame, "sold")

    log = search_log(spark, tables, stage)
    assert len(staged) == 1 and not set(staged[0]) & set(schemas.TRACKING_COLUMNS)
    assert rows(log, *sorted(log.columns)) == rows(search_log(spark, tables), *sorted(log.columns))
