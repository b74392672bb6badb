"""The whole report and its sink."""

import pytest

from adlog.operators import cohorts
from adlog.operators import reports as report_operators
from adlog.plans.marketing_report import Focus, chart_frames, marketing_report, write_marketing_report
from adlog.sources.sinks import read_report_csv
from conftest import rows
from testbed.queries import AS_OF, FOCUS
from testbed.views import COHORT_KEYWORD

KEYWORD_REPORTS = {
    "user_overview",
    "keyword_campaign_matchtype_report",
    "contribution_per_click",
    "orders_per_week",
    "customers_per_month",
    "overall_performance_over_time",
    "keywords_performance_over_time",
    "keywords_campaign_performance_over_time",
    "mobile_performance_over_time",
    "desktop_performance_over_time",
    "cohort_totals",
    "cohort_performance_over_time",
    "cohort_breakeven",
}


@pytest.fixture(scope="module")
def reports(views):
    return marketing_report(views.search_log(), views.bing_log(), views.display_log(), focus=FOCUS)


def test_every_report_is_there(reports):
    assert set(reports) == (
        {f"search/{name}" for name in KEYWORD_REPORTS | {"impression_share_over_time", "click_through_rate_over_time"}}
        | {f"bing/{name}" for name in KEYWORD_REPORTS}
        | {
            f"display/{name}"
            for name in (
                "overall_performance_over_time",
                "desktop_performance_over_time",
                "mobile_performance_over_time",
                "orders_per_week",
            )
        }
        | {"total_customers_per_month"}
    )


def test_one_channel_alone(views):
    found = marketing_report(display=views.display_log(), focus=Focus("x"))
    assert {name.split("/")[0] for name in found} == {"display"}
    assert marketing_report(focus=Focus("x")) == {}


def test_staged_reports_equal_direct_ones(views, reports):
    direct = marketing_report(views.search_log(), focus=FOCUS, stage=lambda frame, label: frame)
    for name in ("search/user_overview", "search/keywords_performance_over_time", "search/cohort_breakeven"):
        assert rows(direct[name]) == rows(reports[name])


def test_reports_are_written_and_read_back(spark, reports, tmp_path):
    some = {name: reports[name] for name in ("search/user_overview", "total_customers_per_month")}
    write_marketing_report(some, str(tmp_path))
    for name, report in some.items():
        assert rows(read_report_csv(spark, str(tmp_path / name), report.schema)) == rows(report)


def test_charts_show_a_part_of_their_report(views, reports):
    logs = {"search": views.search_log(), "bing": views.bing_log(), "display": views.display_log()}
    charts = chart_frames(reports, logs, FOCUS, AS_OF)
    assert set(charts) == {
        "search/click_through_rate_over_time",
        "search/impression_share_over_time",
        *(f"{channel}/{device}_performance_over_time" for channel in logs for device in ("mobile", "desktop")),
    }
    for name, chart in charts.items():
        assert set(rows(chart)) <= set(rows(reports[name]))


def test_sorted_outputs_are_in_order(views):
    """Orders are no part of the comparison with SQL."""
    log = views.search_log()
    earnings = [row.earnings for row in report_operators.keyword_campaign_matchtype_report(log).collect()]
    assert earnings == sorted(earnings, reverse=True) and len(set(earnings)) > 1
    weekly = [(row.keyword is None, row.keyword or "", row.campaign_name is None, row.campaign_name or "", row.week) for row in report_operators.weekly_conversion_metrics(log).collect()]
    assert weekly == sorted(weekly)
    totals = [(row.cohort_week, row.type) for row in cohorts.cohort_totals(log, COHORT_KEYWORD).collect()]
    assert totals == [(week, kind) for week in sorted({w for w, _ in totals}) for kind in ("cohort_cost", "cohort_contribution")]


def test_real_column_types(views):
    """The comparison with SQL casts dates, money and ids with gaps; here they are what they are."""
    log = dict(views.search_log().dtypes)
    for name, kind in {
        "date": "date", "week": "date", "cost": "decimal(18,2)", "money_in_the_bank_paid_to_us": "decimal(18,2)", "campaign_id": "bigint",
        "user_id": "bigint", "impressions": "bigint", "clicks": "bigint", "average_position": "double", "new_referred_users": "bigint",
    }.items():
        assert log[name] == kind, name
    summary = dict(report_operators.keywords_report(views.search_log()).dtypes)
    assert {summary[name] for name in ("cost", "earnings", "average_position", "estimated_available_impressions")} == {"double"}
    assert {summary[name] for name in ("impressions", "clicks", "num_acquisitions", "referred_users")} == {"bigint"}
