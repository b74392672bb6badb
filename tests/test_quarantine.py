"""Report files with what was not understood kept beside the report."""

from adlog.sources import quarantine, reports
from conftest import rows
from test_sources import BING_HEADERS, KEYWORD_HEADERS, KEYWORD_LINES, bing_file, write


def test_faulty_lines_of_search_keyword_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(KEYWORD_HEADERS)
    good, bad, other = KEYWORD_LINES
    short, long = "2016-05-03,Tuesday,Tea", good + ",x,y"
    undated = other.replace("2016-06-01", "June 1")
    write(folder / "a.csv", header, good, bad, short, "")
    write(folder / "b.csv", header, long, undated, other)
    found = quarantine.checked_search_keyword_report(spark, str(folder), "2016-05-01", "2016-06-30")
    want = reports.read_search_keyword_report(spark, write(tmp_path / "good.csv", header, good, bad, other), "2016-05-01", "2016-06-30")
    assert found.report.schema == want.schema
    assert rows(found.report) == rows(want)
    rejected = {row["line"]: (row["file"].rsplit("/", 1)[1], row["reasons"]) for row in found.rejected.collect()}
    assert rejected == {
        bad: ("a.csv", ["campaign_id: x", "cost: oops"]),
        short: ("a.csv", ["number of fields"]),
        long: ("b.csv", ["number of fields"]),
        undated: ("b.csv", ["date: June 1"]),
    }
    # nothing is lost: every line is in the report, rejected or both
    everything = quarantine.checked_search_keyword_report(spark, str(folder))
    assert everything.report.count() == 4 and everything.rejected.count() == 4


def test_faulty_lines_of_the_second_engine(spark, tmp_path):
    good = "5/1/2016,11,+Tea,Active,3,Camp,7,G,2.00,Tablet,10,2,1.5,6,Exact"
    lines = [good, good.replace("2.00", "two"), good.replace("5/1/2016", "2016-05-01"), "5/2/2016,11,+Tea"]
    path = bing_file(tmp_path / "b.csv", *lines)
    found = quarantine.checked_bing_keyword_report(spark, path, "2016-05-01", "2016-05-31")
    assert rows(found.report) == rows(reports.read_bing_keyword_report(spark, bing_file(tmp_path / "g.csv", *lines[:2]), "2016-05-01", "2016-05-31"))
    assert {row["line"]: row["reasons"] for row in found.rejected.collect()} == {
        lines[1]: ["cost: two"], lines[2]: ["date: 2016-05-01"], lines[3]: ["number of fields"],
    }
    assert BING_HEADERS not in {row["line"] for row in found.rejected.collect()}


def test_clean_campaign_files(spark, tmp_path):
    headers = (
        "Day,Day of week,Campaign state,Campaign ID,Campaign,Cost,Network (with search partners),Search Impr. share,"
        "Search Lost IS (rank),Search Lost IS (budget),Device,Budget,Impressions,Clicks,Position"
    )
    line = '2016-05-01,Sunday,enabled,7,"Core, ""B""","1,234.50",Display,45.2%,--,--,Computers,10,"1,000",3,1.5'
    path = write(tmp_path / "c.csv", headers, line)
    found = quarantine.checked_campaign_report(spark, path)
    assert rows(found.report) == rows(reports.read_campaign_report(spark, path, "2016-01-01", "2016-12-31"))
    assert found.rejected.count() == 0
