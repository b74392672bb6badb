"""Kept tables: versions, first orders, the refreshed event log, published reports."""

import datetime as dt
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from adlog.plans.event_logs import search_event_log
from adlog.operators.series import cumulative, keywords_performance_over_time, sum_by_week
from adlog.plans import published
from adlog.plans.kept_log import Increment, KeptLog, Refreshed, bucket_of
from adlog.plans.kept_series import KeptSeries
from adlog.sources.snapshot import FirstOrders
from adlog.sources.store import KeptStore, Store, first_transactions
from adlog.sources.versions import Versions
from conftest import plan_of, rows

ORDERS = "id long, user_id long, created_at timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2016, 1, day, hour)


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.current() == (0, {})
    folders = [versions.new_folder("t") for _ in range(3)]
    for number, folder in enumerate(folders):
        spark.range(number).write.parquet(folder)
        assert versions.publish({"folder": folder}, number) == number + 1
    assert versions.current() == (3, {"folder": folders[2]})
    with pytest.raises(RuntimeError, match="version 3"):
        versions.publish({"folder": "other"}, 2)  # somebody else was first
    assert versions.current() == (3, {"folder": folders[2]})
    assert [p.name for p in (tmp_path / "versions").iterdir() if not p.name.endswith("crc")] and not list((tmp_path / "versions").glob(".*.json"))
    versions.prune(keep=2)
    assert sorted(p.name for p in (tmp_path / "data").iterdir()) == sorted(f.rsplit("/", 1)[1] for f in folders[1:])
    assert versions.current() == (3, {"folder": folders[2]})


def orders(spark, *found):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(found)], ORDERS)


def test_first_orders_merge_in_any_order(spark, tmp_path):
    batches = [
        orders(spark, (1, at(5)), (1, at(7)), (2, at(9, 3)), (None, at(1)), (4, None)),
        orders(spark, (3, at(6)), (2, at(10))),
        orders(spark, (1, at(4)), (2, at(9, 2))),  # earlier ones, late
    ]
    want = [(1, at(4)), (2, at(9, 2)), (3, at(6))]
    for name, order in (("a", (0, 1, 2)), ("b", (2, 1, 0)), ("c", (1, 0, 0, 2, 1))):
        kept = FirstOrders(spark, str(tmp_path / name), buckets=3, compact_after=2)
        for i in order:
            kept.add(batches[i])
        assert rows(kept.rows()) == want
        assert rows(FirstOrders(spark, str(tmp_path / name)).rows()) == want  # buckets are known from the first batch
    with pytest.raises(ValueError, match="no orders"):
        FirstOrders(spark, str(tmp_path / "none")).rows()


def test_a_failed_batch_is_added_again(spark, tmp_path, monkeypatch):
    kept = FirstOrders(spark, str(tmp_path), buckets=2)
    kept.add(orders(spark, (1, at(5))))
    late = orders(spark, (1, at(2)), (2, at(3)))
    with monkeypatch.context() as broken:
        broken.setattr(Versions, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.add(late)
    kept.add(late)
    assert rows(kept.rows()) == [(1, at(2)), (2, at(3))]


def test_only_the_batch_and_the_snapshot_are_read(spark, views, tmp_path):
    store = views.store()
    store.transactions.filter("id % 2 = 0").write.parquet(f"{tmp_path}/old")
    store.transactions.filter("id % 2 = 1").write.parquet(f"{tmp_path}/new")
    kept = FirstOrders(spark, f"{tmp_path}/kept", buckets=4)
    kept.add(spark.read.parquet(f"{tmp_path}/old"))
    batch = kept.batch(spark.read.parquet(f"{tmp_path}/new"))
    assert {path.split("/")[-2] for path in batch.inputFiles()} == {"new"}
    assert "ReadSchema: struct<user_id:bigint,created_at:timestamp" in plan_of(batch)
    kept.add(spark.read.parquet(f"{tmp_path}/new"))
    tables = {name: getattr(store, name) for name in store.__dataclass_fields__}
    found = first_transactions(KeptStore(**tables, first_orders=kept.rows()), "1996-01-01", "1998-12-31")
    assert all("/kept/" in path for path in found.inputFiles())
    assert "Exchange" not in plan_of(found) and "Bucketed: true" in plan_of(found)
    assert rows(found) == rows(first_transactions(store, "1996-01-01", "1998-12-31"))
    # joined with a table in the same buckets, without a shuffle
    spark.range(50).select(F.col("id")).write.bucketBy(4, "id").sortBy("id").option("path", f"{tmp_path}/users").saveAsTable("kept_users")
    assert "Exchange" not in plan_of(found.join(spark.table("kept_users").hint("merge"), "id"))


# ---- the refreshed event log

START, END = "2016-01-01", "2016-03-31"
USERS = range(1, 9)
EVENT = "event string, app int, id string, time long, orderId string, latest_ad_utm_source string, latest_ad_utm_medium string, latest_ad_device string, latest_ad_utm_campaign string, latest_ad_awkeyword string, latest_ad_awadgroupid string, latest_ad_awmatchtype string"


def increment(spark, orders=(), clicks=(), campaigns=(), spend=(), referrals=()):
    """orders: (id, user, day, complete); clicks: (user, day, campaign, keyword); days are strings."""
    store = Store(
        spark.createDataFrame(
            [(i, u, dt.datetime.fromisoformat(day), ok, False, None, Decimal(0), Decimal(0)) for i, u, day, ok in orders],
            "id long, user_id long, created_at timestamp_ntz, complete boolean, refunded boolean, credit decimal(18,2), discount_amount decimal(18,2), sales_tax_amount decimal(18,2)",
        ),
        spark.createDataFrame([(i, None, Decimal(10 + j), False) for i, *_ in orders for j in range(2)], "transaction_id long, discount_id long, price decimal(18,2), recurring boolean"),
        spark.createDataFrame([], "id long, type string, amount decimal(18,2)"),
        spark.createDataFrame([(u, f"user {u}") for u in USERS], "id long, name string"),
        spark.createDataFrame(
            [(u, dt.date.fromisoformat(day), n, Decimal(5)) for u, day, n in referrals],
            "influencer_id long, week_start date, new_referred_users long, referred_users_transaction_amount decimal(18,2)",
        ),
    )
    seconds = [int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.UTC).timestamp()) for _, day, *_ in clicks]
    events = spark.createDataFrame(
        [("Completed Order", 1, str(u), t, f"o{u}-{t}", "Google", "cpc", "dt", str(c), k, "3", "e") for (u, _, c, k), t in zip(clicks, seconds)], EVENT
    )
    named = spark.createDataFrame(list(campaigns), "campaign_id long, campaign_name string")
    paid = spark.createDataFrame(
        [(dt.date.fromisoformat(day), k, Decimal(7)) for day, k in spend], "date date, keyword string, cost decimal(18,2)"
    )
    return Increment(paid, named, events, store)


def at_once(spark, increments):
    """The same log, built from everything that has come in."""
    join = lambda get: reduce(lambda a, b: a.unionByName(b), [get(i) for i in increments])
    names = ("transactions", "transaction_items", "referrals")
    store = Store(**{n: join(lambda i, n=n: getattr(i.store, n)) for n in names}, users=increments[0].store.users, discounts=increments[0].store.discounts)
    return search_event_log(join(lambda i: i.spend), join(lambda i: i.campaigns), join(lambda i: i.events), store, START, END)


SHOWN = ["user_id", "date", "week", "keyword", "campaign_id", "campaign_name", "device", "match_type", "ad_group_id", "money_in_the_bank_paid_to_us", "cost", "new_referred_users"]


def test_refreshed_log_is_that_built_at_once(spark, tmp_path):
    kept = KeptLog(spark, str(tmp_path), START, END, buckets=5, parts=3)
    with pytest.raises(ValueError, match="no log"):
        kept.log()
    bucket = {row["user"]: row["bucket"] for row in spark.createDataFrame([(u,) for u in USERS], "user long").select("user", bucket_of("user", 5)).collect()}
    first = increment(
        spark,
        orders=[(1, 1, "2016-01-05", True), (2, 2, "2016-01-06", True), (3, 3, "2016-02-01", False), (4, 4, "2015-12-01", True), (5, 4, "2016-01-09", True), (6, 5, "2016-01-07", True)],
        clicks=[(1, "2016-01-04", 7, "tea"), (2, "2016-01-05", 8, "mate"), (3, "2016-01-30", 7, "tea"), (4, "2016-01-08", 7, "tea")],
        campaigns=[(7, "Seven")],
        spend=[("2016-01-04", "tea"), ("2016-01-11", "mate")],
        referrals=[(1, "2016-01-11", 2), (3, "2016-02-08", 1), (9, "2016-01-11", 1)],
    )
    steps = [
        (first, None, None),
        # an order of a customer: appended; spend, also of an early week
        (increment(spark, orders=[(7, 1, "2016-02-05", True)], spend=[("2016-02-08", "tea"), ("2016-01-04", "mate")]), set(), {1}),
        # a click that came before the known one, and the first one of a buyer
        (increment(spark, clicks=[(2, "2016-01-02", 7, "green"), (5, "2016-01-06", 8, "black")]), {2, 5}, set()),
        # a click later than the known one changes nothing
        (increment(spark, clicks=[(1, "2016-03-01", 8, "black")]), set(), set()),
        # the first order that counts: weekly metrics of before come in with it
        (increment(spark, orders=[(8, 3, "2016-02-03", True)]), {3}, set()),
        # an order from before the window, late: no new customer after all
        (increment(spark, orders=[(9, 1, "2015-11-01", True)]), {1}, set()),
        # a campaign gets a name, another one a smaller name
        (increment(spark, campaigns=[(8, "Eight"), (7, "Sept")], referrals=[(2, "2016-02-01", 4)]), {2, 3, 5}, set()),
        (increment(spark, campaigns=[(7, "A name")]), {2, 3}, set()),
        (increment(spark), set(), set()),
    ]
    for i, (step, anew, added) in enumerate(steps):
        done = kept.refresh(str(i), step)
        if anew is not None:
            assert set(done.rewritten) == {bucket[u] for u in anew}
            assert set(done.appended) == {bucket[u] for u in added} - set(done.rewritten)
        want = at_once(spark, [step for step, *_ in steps[: i + 1]])
        assert rows(kept.log(), *SHOWN) == rows(want, *SHOWN)
        assert not set(kept.log().columns) & {"time", "transaction_date"}
    assert kept.refresh("0", first) == Refreshed()
    assert rows(KeptLog(spark, str(tmp_path), START, END).log(), *SHOWN) == rows(want, *SHOWN)
    with pytest.raises(ValueError, match="is the log of"):
        KeptLog(spark, str(tmp_path), START, "2016-04-30").log()


def test_a_refresh_reads_the_buckets_it_writes(spark, tmp_path):
    kept = KeptLog(spark, str(tmp_path), START, END, buckets=4)
    users = list(USERS)
    kept.refresh("a", increment(spark, orders=[(u, u, "2016-01-05", True) for u in users], clicks=[(u, "2016-01-04", 7, "tea") for u in users]))
    before = kept.versions.current()[1]["tables"]["log"]["parts"]
    done = kept.refresh("b", increment(spark, clicks=[(1, "2016-01-02", 7, "green")]))
    (changed,) = done.rewritten
    files = kept.sold(done.rewritten).inputFiles()
    assert files and all(f"/bucket={changed}/" in path for path in files)
    assert f"/bucket={changed}/" not in "".join(set(kept.sold([0, 1, 2, 3]).inputFiles()) - set(files))
    after = kept.versions.current()[1]["tables"]["log"]["parts"]
    assert {k for k in before if before[k] != after[k]} == {str(changed)}


def test_a_refresh_that_fails_leaves_the_log(spark, tmp_path, monkeypatch):
    kept = KeptLog(spark, str(tmp_path), START, END, buckets=2)
    a = increment(spark, orders=[(1, 1, "2016-01-05", True)], clicks=[(1, "2016-01-04", 7, "tea")])
    b = increment(spark, orders=[(2, 2, "2016-01-05", True)], clicks=[(2, "2016-01-04", 7, "tea")], spend=[("2016-01-04", "tea")])
    kept.refresh("a", a)
    for broken_at in ("spend", "log", "acquired"):
        with monkeypatch.context() as broken:
            write = KeptLog._write

            def fail(self, now, name, *rest, _at=broken_at):
                return 1 / 0 if name == _at else write(self, now, name, *rest)

            broken.setattr(KeptLog, "_write", fail)
            with pytest.raises(ZeroDivisionError):
                kept.refresh("b", b)
        assert rows(kept.log(), *SHOWN) == rows(at_once(spark, [a]), *SHOWN)
    kept.refresh("b", b)
    assert rows(kept.log(), *SHOWN) == rows(at_once(spark, [a, b]), *SHOWN)


def test_new_rows_are_worked_out_once(spark, tmp_path, monkeypatch):
    """What an increment touches is told by the folders it is written to, not by working out its rows twice."""
    asked, buckets_in = [], KeptLog._buckets_in
    monkeypatch.setattr(KeptLog, "_buckets_in", lambda self, now, new, user: asked.append(user) or buckets_in(self, now, new, user))
    kept = KeptLog(spark, str(tmp_path), START, END, buckets=4)
    a = increment(spark, orders=[(1, 1, "2016-01-05", True)], clicks=[(1, "2016-01-04", 7, "tea")], spend=[("2016-01-04", "tea")])
    b = increment(spark, orders=[(2, 2, "2016-01-05", True)], clicks=[(2, "2016-01-04", 7, "tea"), (1, "2016-01-02", 7, "green")])
    kept.refresh("a", a)
    kept.refresh("b", b)
    assert asked == ["user_id", "user_id"]
    assert rows(kept.log(), *SHOWN) == rows(at_once(spark, [a, b]), *SHOWN)


# ---- resumed series


def series_rows(spark, *found):
    made = [(k, c, week and dt.date.fromisoformat(week), Decimal(cost), Decimal(paid)) for k, c, week, cost, paid in found]
    return spark.createDataFrame(made, "keyword string, campaign_name string, week date, cost decimal(18,2), money_in_the_bank_paid_to_us decimal(18,2)")


def test_series_are_resumed(spark, tmp_path):
    kept = KeptSeries(spark, str(tmp_path))
    parts = [
        (("tea", "a", "2016-01-04", "1.10", "0"), ("tea", "a", "2016-01-11", "2.05", "30"), ("mate", "b", "2016-01-11", "3", "0"), (None, "a", "2016-01-11", "1", "4")),
        (("tea", "b", "2016-01-18", "5", "0"), ("mate", "b", "2016-01-25", "1", "0"), ("new", "b", "2016-01-25", "1", "2"), ("tea", "b", None, "7", "1")),
        (("mate", "a", "2016-01-18", "0", "9"), ("tea", "a", "2016-01-18", "0.01", "0")),  # late
        (),
        (("tea", "a", "2015-12-28", "4", "0"),),  # before all others
    ]
    written = [["2016-01-04", "2016-01-11"], ["2016-01-18", "2016-01-25", "none"], ["2016-01-18", "2016-01-25", "none"], [], None]
    for i, (part, weeks) in enumerate(zip(parts, written, strict=True)):
        done = kept.add(series_rows(spark, *part))
        assert weeks is None or done == weeks
        log = series_rows(spark, *[row for p in parts[: i + 1] for row in p])
        want = keywords_performance_over_time(log)
        assert rows(kept.rows(), *want.columns) == rows(want)
        whole = cumulative(sum_by_week(log, "keyword"), "keyword")
        assert rows(kept.rows(earning_only=False), *whole.columns) == rows(whole)
    assert len(done) == 6


def test_only_changed_weeks_are_read(spark, tmp_path):
    kept = KeptSeries(spark, str(tmp_path), ["keyword", "campaign_name"])
    kept.add(series_rows(spark, *[("tea", "a", f"2016-0{m}-04", "1", "1") for m in range(1, 9)]))
    kept.add(series_rows(spark, ("tea", "a", "2016-07-04", "1", "1"), ("tea", "b", "2016-08-04", "1", "1")))
    _, now = kept.versions.current()
    assert {path.split("part=")[1].split("/")[0] for path in kept.weeks_from(now, "2016-07-04").inputFiles()} == {"2016-07-04", "2016-08-04"}
    early = [path for week, path in now["weeks"].items() if week < "2016-07"]
    assert len({path.rsplit("/weeks", 1)[0] for path in early}) == 1 and len(early) == 6  # left as they were
    found = [row for row in rows(kept.rows(), "campaign_name", "week", "type", "value") if row[2] == "cum_cost"]
    assert found[-2:] == [("a", dt.date(2016, 8, 4), "cum_cost", 9.0), ("b", dt.date(2016, 8, 4), "cum_cost", 1.0)]


# ---- published reports


def test_reports_are_published_as_a_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert published.published_reports(spark, root) == {}
    first = {name: spark.range(n).withColumn("name", F.lit(name)) for n, name in ((2, "a/x"), (3, "b"))}
    assert published.publish_reports(first, root) == 1

    def now():
        return {name: sorted(frame.collect()) for name, frame in published.published_reports(spark, root).items()}

    old = now()
    assert {name: len(found) for name, found in old.items()} == {"a/x": 2, "b": 3}
    second = {name: spark.range(5).withColumn("name", F.lit("new")) for name in ("a/x", "b", "c")}
    write, done = published.write_report_csv, []

    def fail(report, path):
        done.append(path)
        if len(done) == 2:
            raise OSError("disk full")
        write(report, path)

    with monkeypatch.context() as broken:
        broken.setattr(published, "write_report_csv", fail)
        with pytest.raises(OSError, match="disk full"):
            published.publish_reports(second, root, jobs=1)
    assert now() == old
    assert published.publish_reports(second, root) == 2
    assert {name: len(found) for name, found in now().items()} == {"a/x": 5, "b": 5, "c": 5}
    Versions(spark, root).prune(keep=1)
    assert len(list((tmp_path / "data").iterdir())) == 1 and len(now()) == 3
    with pytest.raises(ValueError, match="no reports"):
        published.publish_reports({}, root)
