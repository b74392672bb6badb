import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from adlog.session import apply_settings  # noqa: E402
from testbed.compare import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staging")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = apply_settings(local_session(**folders))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    from testbed.views import Views

    return Views(spark, SMALL)


def plan_of(frame) -> str:
    """The physical plan as text."""
    jvm = frame.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return frame._jdf.queryExecution().explainString(mode)


def rows(frame, *columns):
    """Rows as tuples, sorted, NULLs last."""
    found = frame.select(*columns).collect() if columns else frame.collect()
    return sorted((tuple(row) for row in found), key=lambda row: tuple((v is None, "" if v is None else str(v)) for v in row))
