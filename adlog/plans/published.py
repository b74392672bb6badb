"""The marketing report published as a whole.

Reports are written to a new folder each, and then one manifest makes all of them current. Whoever reads meanwhile has the last
version, complete. A run that fails leaves that version as it is; running again writes every report once more and then
replaces it. Nothing is appended, so no report is there twice.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adlog.sources.sinks import read_report_csv, write_report_csv
from adlog.sources.versions import Versions


def publish_reports(reports: dict[str, DataFrame], root: str, jobs: int = 4) -> int:
    """Write the reports as CSV below ``root``, ``jobs`` of them at a time, make them current, and return their version."""
    if not reports:
        raise ValueError("there are no reports to publish")
    versions = Versions(next(iter(reports.values())).sparkSession, root)
    number, _ = versions.current()
    folder = versions.new_folder("reports")

    def write(item: tuple[str, DataFrame]) -> tuple[str, dict]:
        name, report = item
        write_report_csv(report, f"{folder}/{name}")
        return name, {"path": f"{folder}/{name}", "schema": report.schema.jsonValue()}

    with ThreadPoolExecutor(jobs) as pool:
        written = dict(pool.map(write, reports.items()))
    return versions.publish({"reports": written}, number)


def published_reports(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current version's reports by name; none before the first version."""
    _, now = Versions(spark, root).current()
    return {
        name: read_report_csv(spark, found["path"], StructType.fromJson(found["schema"]))
        for name, found in now.get("reports", {}).items()
    }
