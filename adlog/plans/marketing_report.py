"""The whole marketing report: every report of every channel."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from adlog.channels import BING, SEARCH, Channel
from adlog.functions.dates import DateLike
from adlog.operators.cohorts import cohort_views
from adlog.operators.filters import DESKTOP, MOBILE, REMARKETING_PATTERN, device_slice, recent_weeks
from adlog.operators.reports import (
    best_earners_first,
    by_keyword_campaign_week,
    contribution_of,
    customers_per_month,
    matchtype_summary,
    orders_per_week,
    total_customers_per_month,
    user_overview,
    weekly_metrics,
)
from adlog.operators.series import (
    device_performance_over_time,
    display_device_performance,
    keywords_campaign_performance_over_time,
    keywords_performance_over_time,
    overall_performance_over_time,
    weekly_totals,
)
from adlog.sources.sinks import materialize, write_report_csv

LabelledStage = Callable[[DataFrame, str], DataFrame]

# What the reports read of an event log; a staged log holds nothing else.
REPORT_COLUMNS = (
    "date",
    "week",
    "keyword",
    "campaign_name",
    "match_type",
    "device",
    "cost",
    "impressions",
    "clicks",
    "average_position",
    "est_search_impression_share",
    "user_id",
    "user_name",
    "money_in_the_bank_paid_to_us",
    "new_referred_users",
    "referred_users_transaction_amount",
)


@dataclass(frozen=True)
class Focus:
    """The keyword and the campaigns a report looks at more closely."""

    keyword: str
    campaign: str | None = None


def _keyword_reports(
    elog: DataFrame, weekly: DataFrame, focus: Focus, channel: Channel, campaign: str | None, stage: LabelledStage
) -> dict[str, DataFrame]:
    cohorts = cohort_views(elog, focus.keyword, lambda rows: stage(rows, f"{channel.name}-cohorts"))
    summary = stage(matchtype_summary(elog, channel=channel), f"{channel.name}-matchtype")
    return {
        "user_overview": user_overview(elog),
        "keyword_campaign_matchtype_report": best_earners_first(summary),
        "contribution_per_click": contribution_of(summary),
        "orders_per_week": orders_per_week(elog, focus.keyword, campaign),
        "customers_per_month": customers_per_month(elog),
        "overall_performance_over_time": overall_performance_over_time(weekly),
        "keywords_performance_over_time": keywords_performance_over_time(weekly),
        "keywords_campaign_performance_over_time": keywords_campaign_performance_over_time(weekly),
        "mobile_performance_over_time": device_performance_over_time(weekly, focus.keyword),
        "desktop_performance_over_time": device_performance_over_time(weekly, focus.keyword),
        **cohorts,
    }


def marketing_report(
    search: DataFrame | None = None,
    bing: DataFrame | None = None,
    display: DataFrame | None = None,
    *,
    focus: Focus,
    stage: LabelledStage = materialize,
) -> dict[str, DataFrame]:
    """Every report by ``channel/name``: the DataFrames are lazy, the staged tables under them are written by this call.

    The channels are worked on side by side. Each log is staged once, in columns. So is every summary of it that more than one report builds on: the
    weekly totals (five series), the cohorts' weeks, the match-type summary and the weekly metrics. Pass
    ``stage=lambda rows, label: rows`` to stage nothing.
    """

    def staged(log: DataFrame, label: str) -> DataFrame:
        return stage(log.select(*[name for name in REPORT_COLUMNS if name in log.columns]), label)

    def of_search() -> dict[str, DataFrame]:
        log = staged(search, "search-log")
        weekly = stage(weekly_totals(log), "search-weekly")
        metrics = by_keyword_campaign_week(stage(weekly_metrics(log, focus.campaign, channel=SEARCH), "search-metrics"))
        found = _keyword_reports(log, weekly, focus, SEARCH, focus.campaign, stage)
        return found | {"impression_share_over_time": metrics, "click_through_rate_over_time": metrics}

    def of_bing() -> dict[str, DataFrame]:
        log = staged(bing, "bing-log")
        return _keyword_reports(log, stage(weekly_totals(log), "bing-weekly"), focus, BING, None, stage)

    def of_display() -> dict[str, DataFrame]:
        log = staged(display, "display-log")
        weekly = stage(weekly_totals(log), "display-weekly")
        devices = display_device_performance(weekly)
        return {
            "overall_performance_over_time": overall_performance_over_time(weekly),
            "desktop_performance_over_time": devices,
            "mobile_performance_over_time": devices,
            "orders_per_week": orders_per_week(log, campaign=REMARKETING_PATTERN),
        }

    channels = {"search": (search, of_search), "bing": (bing, of_bing), "display": (display, of_display)}
    with ThreadPoolExecutor(len(channels)) as pool:
        running = {name: pool.submit(build) for name, (log, build) in channels.items() if log is not None}
        reports = {f"{channel}/{name}": frame for channel, made in running.items() for name, frame in made.result().items()}
    if search is not None and bing is not None:
        reports["total_customers_per_month"] = total_customers_per_month(
            reports["search/customers_per_month"], reports["bing/customers_per_month"]
        )
    return reports


def chart_frames(reports: dict[str, DataFrame], weekly_logs: dict[str, DataFrame], focus: Focus, as_of: DateLike):
    """The rows each chart of the report shows, where that is less than the report itself.

    ``weekly_logs`` are event logs, or their weekly totals, by channel. The second engine's click-through chart needs its weekly
    conversion metrics among the reports, as ``bing/click_through_rate_over_time``. Desktop charts, and both of the second
    engine's, show earning keywords only.
    """
    charts: dict[str, DataFrame] = {}
    if "search" in weekly_logs:
        recent = recent_weeks(reports["search/click_through_rate_over_time"], as_of, focus.keyword)
        charts["search/click_through_rate_over_time"] = recent
        charts["search/impression_share_over_time"] = recent
    for channel, earning_only in (("search", False), ("bing", True)):
        if channel in weekly_logs:
            log = weekly_logs[channel]
            charts[f"{channel}/mobile_performance_over_time"] = device_performance_over_time(
                log, focus.keyword, device=MOBILE, earning_only=earning_only
            )
            charts[f"{channel}/desktop_performance_over_time"] = device_performance_over_time(
                log, focus.keyword, device=DESKTOP, earning_only=True
            )
    if "bing" in weekly_logs and "bing/click_through_rate_over_time" in reports:
        metrics = reports["bing/click_through_rate_over_time"]
        charts["bing/click_through_rate_over_time"] = recent_weeks(metrics, as_of, focus.keyword)
    if "display" in weekly_logs:
        for device, name in ((MOBILE, "mobile"), (DESKTOP, "desktop")):
            whole = reports[f"display/{name}_performance_over_time"]
            charts[f"display/{name}_performance_over_time"] = device_slice(whole, device)
    return charts


def write_marketing_report(reports: dict[str, DataFrame], folder: str, jobs: int = 4) -> None:
    """Write each report as CSV under ``folder``, ``jobs`` of them at a time.

    The reports are independent Spark jobs, most of them with a small last stage: side by side, one fills the
    cores another leaves idle.
    """

    def write(item: tuple[str, DataFrame]) -> None:
        name, report = item
        write_report_csv(report, f"{folder.rstrip('/')}/{name}")

    with ThreadPoolExecutor(jobs) as pool:
        list(pool.map(write, reports.items()))
