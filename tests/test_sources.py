"""Report files, event files and the store extract."""

import csv
import datetime as dt
import io
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adlog import schemas
from adlog.channels import SEARCH
from adlog.functions import scalars
from adlog.functions.dates import within
from adlog.sources import events, reports, sinks, store
from conftest import rows

KEYWORD_HEADERS = [
    "Day", "Day of week", "Keyword", "Keyword state", "Campaign ID", "Campaign", "Ad group ID", "Ad group", "Cost",
    "Network (with search partners)", "Search Impr. share", "Search Lost IS (rank)", "Device", "Impressions",
    "Clicks", "Position", "Quality score", "Landing page experience", "Match type",
]
KEYWORD_LINES = [
    '2016-05-01,Sunday,"+Paper  +Cups",enabled,3000000000,"Core, ""A""",7,G,1.25,Google search,0.5,0.1,Computers,10,2,1.5,--,Average,Exact',
    "2016-05-02,Monday,Tea,enabled,x,Core,7,G,oops,Google search,--,0.1,Mobile devices with full browsers,10,2,1.5,7,Average,Broad",
    "2016-06-01,Wednesday,Tea,enabled,3,Core,7,G,1.00,Google search,0.5,0.1,Computers,10,2,1.5,7,Average,Broad",
]


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_search_keyword_file(spark, tmp_path):
    path = write(tmp_path / "k.csv", ",".join(KEYWORD_HEADERS), *KEYWORD_LINES)
    found = reports.read_search_keyword_report(spark, path, "2016-05-01", "2016-05-31")
    assert found.columns == [name for name, _ in schemas.SEARCH_KEYWORD_COLUMNS.values()]
    assert [field.dataType for field in found.schema] == [kind for _, kind in schemas.SEARCH_KEYWORD_COLUMNS.values()]
    first, second = found.orderBy("date").collect()
    assert (first.date, first.keyword, first.campaign_id, first.campaign_name) == (
        dt.date(2016, 5, 1), "paper cups", 3000000000, 'Core, "A"',
    )
    assert (first.cost, first.device, first.quality_score) == (Decimal("1.25"), "dt", None)
    assert (second.campaign_id, second.cost, second.est_search_impression_share, second.device) == (None, None, None, "mb")
    assert second.quality_score == 7.0


def test_column_order_of_a_file_does_not_matter(spark, tmp_path):
    path = write(tmp_path / "k.csv", "Clicks,Device,Keyword,Day,Quality score,Extra (field)", "3,Computers,+A,2016-05-01,5,e")
    row = reports.read_search_keyword_report(spark, path, "2016-05-01", "2016-05-01").head()
    assert (row.clicks, row.device, row.keyword, row.extrafield) == (3, "dt", "a", "e")


def test_campaign_file(spark, tmp_path):
    headers = (
        "Day,Day of week,Campaign state,Campaign ID,Campaign,Cost,Network (with search partners),Search Impr. share,"
        "Search Lost IS (rank),Search Lost IS (budget),Device,Budget,Impressions,Clicks,Position"
    )
    line = "2016-05-01,Sunday,enabled,5,Rmktg,2.50,Display,0.5,0.1,0.2,Tablets with full browsers,100.00,10,2,1.5"
    path = write(tmp_path / "c.csv", headers, line)
    found = reports.read_campaign_report(spark, path, "2016-05-01", "2016-05-01")
    assert found.columns == [name for name, _ in schemas.CAMPAIGN_COLUMNS.values()]
    row = found.head()
    assert (row.campaign_id, row.device, row.budget) == (5, "dt", Decimal("100.00"))


BING_HEADERS = (
    '"Gregorian date","Keyword ID","Keyword","Keyword status","Campaign ID","Campaign name","Ad group ID","Ad group",'
    '"Spend","Device type","Impressions","Clicks","Avg. position","Quality score","Delivered match type"'
)
BING_PREAMBLE = ['"Report Name: x"', '"Report Time: 5/1/2016"', "", "1/1", "a,b", "c", "d", "e", '"Rows: 3"']
BING_FOOTER = '"©2016 Some Corporation. All rights reserved. "'


def bing_file(path, *lines):
    return write(path, *BING_PREAMBLE, BING_HEADERS, *lines, BING_FOOTER)


def test_bing_keyword_file(spark, tmp_path):
    path = bing_file(
        tmp_path / "b.csv",
        '5/1/2016,11,"+Paper  +Cups",Active,3,"Camp, one",7,G,1.25,Smartphone,10,2,1.5,6,Exact',
        '05/02/2016,12,Tea,Active,3,Camp,7,G,2.00,Tablet,10,2,1.5,6,Exact',
        '6/1/2016,12,Tea,Active,3,Camp,7,G,2.00,Tablet,10,2,1.5,6,Exact',
    )
    found = reports.read_bing_keyword_report(spark, path, "2016-05-01", "2016-05-31")
    assert rows(found, "date", "keyword_id", "keyword", "campaign_name", "device", "cost", "day_of_week") == [
        (dt.date(2016, 5, 1), 11, "paper  cups", "Camp, one", "mb", Decimal("1.25"), "Sunday"),
        (dt.date(2016, 5, 2), 12, "tea", "Camp", "dt", Decimal("2.00"), "Monday"),
    ]


def test_bing_files_are_read_together(spark, tmp_path):
    line = "5/1/2016,{},Tea,Active,3,Camp,7,G,2.00,Tablet,10,2,1.5,6,Exact"
    bing_file(tmp_path / "b1.csv", line.format(1), line.format(2))
    bing_file(tmp_path / "b2.csv", line.format(3))
    found = reports.read_bing_keyword_report(spark, str(tmp_path), "2016-05-01", "2016-05-31")
    assert rows(found, "keyword_id") == [(1,), (2,), (3,)]


def test_bing_file_without_header(spark, tmp_path):
    with pytest.raises(ValueError, match="Gregorian date"):
        reports.read_bing_keyword_report(spark, write(tmp_path / "b.csv", "1,2"), "2016-05-01", "2016-05-31")


def event(name="Completed Order", **properties):
    base = {"time": 1462104000, "id": "1", "orderId": "o1", "latest_ad_utm_source": "Google", "latest_ad_utm_medium": "cpc"}
    return json.dumps({"event": name, "properties": base | properties})


def test_events_file(spark, tmp_path):
    path = write(
        tmp_path / "e.json",
        event(),
        event(id="2", latest_ad_utm_source="Bing", **{"$city": "Oslo"}),
        event(id="abc"),
        event("Viewed", id="4"),
        event(id="5", latest_ad_utm_medium="email"),
        event(id="6", latest_ad_utm_source="Yahoo"),
        event(id="7", time=1462060799),
        event(id="8", time=1462060800),
        event(id="9", time=1462147199),
        event(id="10", time=1462147200),
    )
    flat = events.read_events(spark, path)
    assert "x_city" in flat.columns and "$city" not in flat.columns
    by_channel = events.conversions_by_channel(flat, "2016-05-01", "2016-05-01")
    assert rows(by_channel["search"], "app_user_id") == [(1,), (8,), (9,), (None,)]
    assert rows(by_channel["bing"], "app_user_id", "x_city") == [(2, "Oslo")]


def make_store(spark, transactions, items, discounts=(), users=((1, "Ann"), (2, "Bob")), referrals=()):
    def money(value):
        return None if value is None else Decimal(str(value))

    return store.Store(
        transactions=spark.createDataFrame(
            [(i, u, at, done, back, money(c), money(d), money(t)) for i, u, at, done, back, c, d, t in transactions],
            """id long, user_id long, created_at timestamp_ntz, complete boolean, refunded boolean,
            credit decimal(18,2), discount_amount decimal(18,2), sales_tax_amount decimal(18,2)""",
        ),
        transaction_items=spark.createDataFrame(
            [(t, d, money(p), r) for t, d, p, r in items],
            "transaction_id long, discount_id long, price decimal(18,2), recurring boolean",
        ),
        discounts=spark.createDataFrame(
            [(i, kind, money(amount)) for i, kind, amount in discounts], "id long, type string, amount decimal(18,2)"
        ),
        users=spark.createDataFrame(list(users), "id long, name string"),
        referrals=spark.createDataFrame(
            [(u, week, n, money(m)) for u, week, n, m in referrals],
            """influencer_id long, week_start date, new_referred_users long,
            referred_users_transaction_amount decimal(18,2)""",
        ),
    )


def at(day, hour=0):
    return dt.datetime(2016, 5, day, hour)


def test_transactions_extract(spark):
    tables = make_store(
        spark,
        transactions=[
            (1, 1, at(1), True, False, 0, 2, 1),
            (2, 1, at(2), True, True, 5, 0, 0),
            (3, 2, at(3), True, False, 5, 0, 0),
            (4, 2, at(4), True, False, None, 0, 0),
            (5, 2, at(5), False, False, 0, 0, 0),
            (6, 2, at(6, 0), True, False, 0, 0, 0),
            (7, 2, at(6, 1), True, False, 0, 0, 0),
            (8, 9, at(2), True, False, 0, 0, 0),
        ],
        items=[
            (1, None, 10, False),
            (1, 7, 20, True),
            (2, 8, 30, True),
            (3, 99, 40, False),
            (4, None, 50, True),
            (5, None, 60, True),
            (6, None, 70, False),
            (7, None, 80, False),
            (8, None, 90, False),
        ],
        discounts=[(7, "GiftCard", 25), (8, "Promo", 3)],
    )
    found = store.transactions_extract(tables, "2016-05-01", "2016-05-05")
    columns = ["app_user_id", "user_name", "refund_amount", "retail_price", "money_in_the_bank_paid_to_us", "purchase_type"]
    single, recurring, card = "One-Time Meal Purchase", "Recurring Food Purchase", "Gift Card"
    assert rows(found.select(*[found[c].cast("string") for c in columns])) == sorted(
        [
            ("1", "Ann", "0.00", "11.00", "10.00", single),
            ("1", "Ann", "0.00", "25.00", "20.00", card),
            ("1", "Ann", "30.00", "30.00", "0.00", recurring),
            ("2", "Bob", "0.00", "40.00", "35.00", single),
            ("2", "Bob", "0.00", "50.00", "50.00", recurring),
            ("2", "Bob", "0.00", "70.00", "70.00", single),
        ]
    )


def test_first_transactions_count_incomplete_ones(spark):
    tables = make_store(
        spark,
        transactions=[
            (1, 1, at(1), False, False, 0, 0, 0),
            (2, 1, at(10), True, False, 0, 0, 0),
            (3, 2, at(10, 23), True, False, 0, 0, 0),
            (4, 3, at(10), True, False, 0, 0, 0),
        ],
        items=[],
    )
    found = store.first_transaction_dates(tables, "2016-05-05", "2016-05-10")
    assert rows(found, "id", "name", "first_transaction") == [(2, "Bob", at(10, 23))]


def test_query_file(spark, tmp_path):
    path = write(tmp_path / "q.sql", "SELECT id FROM {numbers} WHERE id BETWEEN :low AND :high")
    found = store.run_query_file(spark, path, {"low": 3, "high": 5}, {"numbers": spark.range(10)})
    assert rows(found) == [(3,), (4,), (5,)]


def test_campaign_stage_newest_first(spark):
    days = [dt.date(2016, 5, day) for day in (3, 1, 9, 2)]
    frame = spark.createDataFrame([(day,) for day in days], "date date")
    assert [row.date.day for row in store.campaign_stage(frame, "2016-05-01", "20160503").collect()] == [3, 2, 1]


def test_report_csv(spark, tmp_path):
    report = spark.createDataFrame([("a \"b\", c", 1.5, None), ("é", None, 2)], "name string, x double, n long")
    path = str(tmp_path / "report")
    sinks.write_report_csv(report.coalesce(1), path)
    (part,) = [file for file in (tmp_path / "report").iterdir() if file.name.startswith("part-")]
    assert part.read_bytes().decode() == 'name,x,n\r\n"a ""b"", c",1.5,NA\r\né,NA,2\r\n'
    assert rows(sinks.read_report_csv(spark, path, report.schema)) == rows(report)


def test_staged_tables_go_where_the_cluster_says(spark):
    root = Path(spark.conf.get(sinks.CHECKPOINT_SETTING))
    staged = sinks.materialize(spark.range(3), "numbers")
    assert rows(staged) == [(0,), (1,), (2,)]
    assert [path.parent for path in root.glob("adlog/numbers-*")] == [root / "adlog"]


class Settings(dict):
    """A session with these settings only."""

    @property
    def conf(self):
        return self


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match=sinks.CHECKPOINT_SETTING):
        sinks.staging_root(Settings({"spark.master": "yarn"}))
    assert sinks.staging_root(Settings({"spark.master": "yarn", sinks.CHECKPOINT_SETTING: "hdfs:/s/"})) == "hdfs:/s"
    assert Path(sinks.staging_root(Settings({"spark.master": "local[2]"}))).is_dir()


def test_one_conversion_per_user_is_the_earliest(spark):
    from adlog.operators.attribution import clean_tags, one_conversion_per_user

    data = [(1, 20, "b", "x"), (1, 10, "b", "7"), (1, 10, "a", "8"), (2, None, "c", "9"), (2, 5, "d", "10")]
    conversions = spark.createDataFrame(data, "app_user_id long, time long, orderId string, latest_ad_utm_campaign string")
    from pyspark.sql import functions as F

    tagged = conversions.select("*", *[F.lit("b").alias(f"latest_ad_{t}") for t in ("device", "awkeyword", "awadgroupid", "awmatchtype")])
    kept = clean_tags(one_conversion_per_user(tagged), SEARCH)
    assert rows(kept, "app_user_id", "orderId", "campaign_id", "match_type") == [(1, "a", 8, "Broad"), (2, "d", 10, "Broad")]


def swapped(header, line, one, other):
    """A header and a line with two columns changed about."""
    fields = next(csv.reader([line]))
    i, j = header.index(one), header.index(other)
    header = list(header)
    for values in (header, fields):
        values[i], values[j] = values[j], values[i]
    out = io.StringIO()
    csv.writer(out).writerow(fields)
    return ",".join(header), out.getvalue().strip()


def test_files_with_another_column_order_are_not_misread(spark, tmp_path):
    write(tmp_path / "a.csv", ",".join(KEYWORD_HEADERS), KEYWORD_LINES[0])
    write(tmp_path / "b.csv", *swapped(KEYWORD_HEADERS, KEYWORD_LINES[0], "Impressions", "Clicks"))
    with pytest.raises(Exception, match="CSV header"):
        reports.read_search_keyword_report(spark, str(tmp_path), "2016-05-01", "2016-05-31").collect()


def test_second_engine_files_with_another_column_order_are_not_misread(spark, tmp_path):
    line = "5/1/2016,11,+Tea,Active,3,Camp,7,G,2.00,Tablet,10,2,1.5,6,Exact"
    bing_file(tmp_path / "a.csv", line)
    headers = [h.strip('"') for h in BING_HEADERS.split(",")]
    header, other = swapped(headers, line, "Impressions", "Clicks")
    write(tmp_path / "b.csv", *BING_PREAMBLE, header, other, BING_FOOTER)
    with pytest.raises(ValueError, match="b.csv"):
        reports.read_bing_keyword_report(spark, str(tmp_path), "2016-05-01", "2016-05-31")


def test_number_formats_of_exports(spark, tmp_path):
    header = ["Day", "Impressions", "Clicks", "Cost", "Search Impr. share", "Campaign ID"]
    lines = ['2016-05-01,"1,234,567",12.0,"1,234.50",45.2%,1E5', "2016-05-01, 7 ,,--,0.5,x", '2016-05-01,"1,000",3,2,"1,000 %",12.7']
    path = write(tmp_path / "n.csv", ",".join(header), *lines)
    raw = reports.read_csv_report(spark, path)
    report = reports.cast_columns(reports.rename_headers(raw, schemas.SEARCH_KEYWORD_COLUMNS), schemas.SEARCH_KEYWORD_COLUMNS)
    names = ["impressions", "clicks", "cost", "est_search_impression_share", "campaign_id"]
    assert [tuple(r) for r in report.select(names).collect()] == [
        (1234567, 12, Decimal("1234.50"), 0.452, 100000),
        (7, None, None, 0.5, None),
        (1000, 3, Decimal("2.00"), 10.0, 12),
    ]
    lost = reports.unparsed_cells(raw, schemas.SEARCH_KEYWORD_COLUMNS).first().asDict()
    assert {k: v for k, v in lost.items() if v} == {"cost": 1, "campaign_id": 1}


def test_ids_written_as_decimals(spark):
    frame = spark.createDataFrame([("123.0",), ("1E5",), (" 7 ",), ("x",), ("",), (None,), ("3000000000",)], "id string")
    assert [r[0] for r in frame.select(scalars.whole_number(F.col("id"))).collect()] == [123, 100000, 7, None, None, None, 3000000000]
    assert frame.select(scalars.keyword_id_from_tag(F.lit("kwd-55.0"))).first()[0] == 55


def test_bounds_with_a_time_of_day(spark):
    frame = spark.sql("SELECT timestamp'2016-05-01 03:00:00' AS t UNION ALL SELECT timestamp'2016-05-01 05:00:00' UNION ALL SELECT timestamp'2016-05-03 04:00:00'")
    count = lambda start, end: frame.filter(within("t", start, end)).count()
    assert count("2016-05-01", "2016-05-03") == 3
    assert count("2016-05-01 04:00:00", "2016-05-03 03:59:59") == 1
    assert count(dt.datetime(2016, 5, 1, 4), "2016-05-03") == 2


def test_staged_folders_can_be_removed(spark):
    run = sinks.new_folder(spark, "run")
    table = sinks.materialize(spark.range(3), "part", run)
    assert table.count() == 3
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent.parent
    assert folder.exists()
    sinks.remove_folder(spark, run)
    assert not folder.exists()


def test_lines_of_data_are_told_by_their_first_character(spark, tmp_path):
    """The header is looked for with a cheap test first, which any spelling of it passes."""
    headers = BING_HEADERS.replace("Gregorian date", " gREGORIAN-Date ")
    write(tmp_path / "b.csv", "5/1/2016,g,Gregorian date", '"5/2/2016",Gregorian date', headers)
    assert [reports.header_key(name) for name in reports.bing_headers(spark, str(tmp_path))][0] == "gregoriandate"
    lines = ["5/1/2016,g", '"5/1/2016",Gregorian date', ",Gregorian date", "Report: Gregorian date", '" Gregorian date"', "gregorian date", "- Gregorian"]
    found = spark.createDataFrame([(line,) for line in lines], "value string").filter(F.col("value").rlike(reports.BING_HEADER_START))
    assert rows(found) == sorted((line,) for line in lines[-3:])
