"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores           (default: all)
BENCH_REPEATS  timed runs per query  (default 2, the median counts; one run before them warms up)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from adlog.operators.cohorts import cohort_views  # noqa: E402
from adlog.plans.event_logs import event_logs  # noqa: E402
from adlog.plans.marketing_report import marketing_report, write_marketing_report  # noqa: E402
from adlog.session import apply_settings  # noqa: E402
from adlog.sources.sinks import materialize, new_folder  # noqa: E402
from testbed.compare import local_session  # noqa: E402
from testbed.queries import FOCUS, QUERIES  # noqa: E402
from testbed.views import COHORT_KEYWORD, END, START, Views  # noqa: E402

SINGLE = [
    "ingest_search_keyword_report",
    "transactions_extract",
    "first_transaction_dates",
    "search_event_log",
    "bing_event_log",
    "display_event_log",
    "summarize_elog",
    "keywords_report",
    "keyword_campaign_matchtype_report",
    "contribution_per_click",
    "weekly_conversion_metrics",
    "user_overview",
    "customers_per_month",
    "orders_per_week",
    "overall_performance_over_time",
    "keywords_performance_over_time",
    "keywords_campaign_performance_over_time",
    "device_performance_over_time",
]


def cohorts(v: Views) -> None:
    for frame in cohort_views(v.search_log(), COHORT_KEYWORD, lambda rows: materialize(rows, "cohorts")).values():
        run(frame)


def whole_report(v: Views) -> None:
    """All event logs, all reports, all written as CSV."""
    logs = event_logs(v.sources(), START, END, lambda rows: materialize(rows, "sold"))
    reports = marketing_report(logs.search, logs.bing, logs.display, focus=FOCUS)
    write_marketing_report(reports, new_folder(v.spark, "report"))


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def measure(v: Views, job: Callable[[Views], None], repeats: int) -> float:
    times = []
    for _ in range(repeats + 1):
        began = time.perf_counter()
        job(v)
        times.append(time.perf_counter() - began)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", 2))
    v = Views(apply_settings(local_session(cores, cores)), folder)
    seconds = {name: measure(v, lambda v, name=name: run(QUERIES[name](v)), repeats) for name in SINGLE}
    seconds["cohort_views"] = measure(v, cohorts, repeats)
    seconds["marketing_report"] = measure(v, whole_report, 1)
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
