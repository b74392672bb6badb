"""Several grains from one pass over the log: exact distinct users by bitmaps, KPIs by grouping sets."""

from itertools import chain

import pytest
from pyspark.sql import functions as F

from adlog.channels import BING
from adlog.operators import kpis, rollups
from adlog.sources.sinks import materialize
from conftest import plan_of, rows

GRAINS = {"total": [], "keyword": ["keyword"], "week": ["keyword", "week"], "weeks": ["week"]}
#: Users with far, negative and neighbouring ids.
USERS = [None, None, 0, -1, -40_000, 1, 2, 32_768, 32_769, 9_000_000_000_000_000_000, -9_000_000_000_000_000_000, *range(100, 140)]


def log_rows():
    return [(["tea", "mate", None][(i * i + j) % 3], [None, 1, 2, 3][(i + j * j) % 4], user) for j, user in enumerate(USERS) for i in range(1 + j % 5)]


def counted(found, grain):
    users = {}
    for keyword, week, user in found:
        key = {"total": (None, None), "keyword": (keyword, None), "week": (keyword, week), "weeks": (None, week)}[grain]
        users.setdefault(key, set()).update(() if user is None else (user,))
    return {(grain, *key, len(of)) for key, of in users.items()}


def test_users_of_every_grain(spark):
    log = spark.createDataFrame(log_rows(), "keyword string, week long, user_id long").repartition(5)
    found = rollups.acquisitions_rollup(log, GRAINS).select("grain", "keyword", "week", "num_acquisitions")
    want = set(chain.from_iterable(counted(log_rows(), grain) for grain in GRAINS))
    assert set(rows(found)) == want and found.count() == len(want)
    assert rows(rollups.acquisitions_rollup(log.filter("false"), {"keyword": ["keyword"]})) == []


def test_cells_of_two_logs_merge(spark):
    """Weeks that come in later are put beside those that are there; their users are not counted twice."""
    log = spark.createDataFrame(log_rows(), "keyword string, week long, user_id long")
    numbers = materialize(rollups.user_numbers(log.select("keyword", "week", "user_id"), ["keyword", "week"]), "user-numbers")
    early, late = log.filter("week <= 2 or week is null"), log.filter("week > 2")
    both = [rollups.cells(part, ["keyword", "week"], numbers=numbers) for part in (early, late)]
    found = rollups.roll_up(both[0].unionByName(both[1]), GRAINS).select("grain", "keyword", "week", "num_acquisitions")
    assert set(rows(found)) == set(chain.from_iterable(counted(log_rows(), grain) for grain in GRAINS))


def test_users_of_one_cell_share_bitmaps(spark):
    """Numbers follow the keys, not the ids, so that far ids make no more bitmaps than near ones."""
    per_user = spark.range(3000).select((F.col("id") * 1_000_003).alias("user_id"), F.concat(F.lit("k"), F.col("id") % 3).alias("keyword"))
    found = rollups.cells(per_user, ["keyword"])
    partitions = per_user.repartition(8).orderBy("keyword").rdd.getNumPartitions()
    assert found.count() <= 3 + partitions
    assert rows(rollups.roll_up(found, {"keyword": ["keyword"]}), "keyword", "num_acquisitions") == [("k0", 1000), ("k1", 1000), ("k2", 1000)]


def test_the_log_is_read_once(spark, views, tmp_path):
    views.search_log().write.parquet(f"{tmp_path}/log")
    log, read = spark.read.parquet(f"{tmp_path}/log"), []

    def stage(frame, label):
        read.append((label, any(f"{tmp_path}/log" in path for path in frame.inputFiles()), plan_of(frame).count("FileScan")))
        return materialize(frame, label)

    grains = {"total": [], "keyword": ["keyword"], "match_type": ["keyword", "campaign_name", "match_type"]}
    found = rollups.kpi_rollup(log, grains, stage=stage)
    assert [(label, of_log) for label, of_log, _ in read] == [("per-user", True), ("user-numbers", False), ("cells", False)]
    assert read[0][2] == 1 and plan_of(found).count("FileScan") == 1 and "Python" not in plan_of(found)
    for grain, keys in grains.items():
        want = kpis.summarize_elog(log, *keys)
        assert rows(found.filter(F.col("grain") == grain), *want.columns) == rows(want)


@pytest.mark.parametrize("channel", [BING])
def test_columns_that_a_log_lacks(spark, views, channel):
    log = views.bing_log().drop("new_referred_users", "referred_users_transaction_amount")
    want = kpis.summarize_elog(log, "keyword", channel=channel)
    found = rollups.kpi_rollup(log, {"keyword": ["keyword"]}, channel=channel)
    assert rows(found, *want.columns) == rows(want)


def test_bitmaps_take_room_by_their_users(spark):
    """A set of one user is one word, and words are merged without sorting rows of whole bitmaps."""
    log = spark.range(2000).select(F.col("id").alias("user_id"), F.concat(F.lit("k"), F.col("id") % 997).alias("keyword"))
    found = rollups.cells(log, ["keyword"])
    assert found.agg(F.sum(F.size("users"))).first()[0] <= 2000
    plan = plan_of(rollups.roll_up(found, {"total": [], "keyword": ["keyword"]}))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    counts = rollups.roll_up(found, {"total": []}).collect()
    assert [row["num_acquisitions"] for row in counts] == [2000]
