"""Where results go: CSV reports, and staged tables between the steps of a job."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"
NULL_TEXT = "NA"
# local-cluster and cluster masters have executors that share no temporary folder.
LOCAL_MASTER = re.compile(r"local(\[|$)")


def write_report_csv(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a report as CSV with a header, CRLF line ends, doubled quotes and ``NA`` for NULL.

    ``path`` becomes a folder of part files, written by the tasks that hold the rows.
    """
    (
        report.write.mode(mode)
        .option("header", True)
        .option("lineSep", "\r\n")
        .option("nullValue", NULL_TEXT)
        .option("escape", '"')
        .csv(path)
    )


def read_report_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read back what :func:`write_report_csv` wrote."""
    return spark.read.csv(path, schema=schema, header=True, lineSep="\r\n", nullValue=NULL_TEXT, escape='"')


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one local process without the setting, as in tests, gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not LOCAL_MASTER.match(spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="adlog-")


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, label: str, run: str | None = None) -> str:
    """The path of a new folder in the staging folder, or in the folder of a run. It goes when the driver ends."""
    path = f"{run or staging_root(spark) + '/adlog'}/{label}-{uuid.uuid4().hex}"
    there, files = _file_system(spark, path)
    files.deleteOnExit(there)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove what a job has staged, once its results are written."""
    there, files = _file_system(spark, path)
    files.delete(there, True)


def materialize(rows: DataFrame, label: str, run: str | None = None) -> DataFrame:
    """Write rows to a Parquet table in the staging folder, or in the folder of a run, and return the table.

    It cuts the plan there: later jobs scan only the columns they need, and a lost executor costs a re-read
    instead of the whole lineage. Pass a run's :func:`new_folder` to be able to :func:`remove_folder` all of it at the end.
    """
    spark = rows.sparkSession
    path = new_folder(spark, label, run)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
