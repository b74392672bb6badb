"""Series and cohorts against plain Python on small and random logs."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from adlog.operators import cohorts, series
from conftest import rows
from test_kpis import elog

MONDAY = dt.date(2016, 1, 4)


def week(number):
    return MONDAY + dt.timedelta(weeks=number)


def random_events(seed, n=300):
    pick = random.Random(seed)
    events = []
    for _ in range(n):
        event = dict(
            week=week(pick.randrange(12)),
            keyword=pick.choice(["k", "k", "k", "other", None]),
            campaign_name=pick.choice(["c", "d", None]),
            device=pick.choice(["dt", "mb"]),
        )
        kind = pick.random()
        if kind < 0.5:
            event |= dict(cost=Decimal(pick.randrange(1, 900)) / 100)
        else:
            event |= dict(user_id=pick.randrange(25))
            if kind < 0.9:
                event |= dict(money_in_the_bank_paid_to_us=Decimal(pick.randrange(0, 9000)) / 100)
        events.append(event)
    return events


def expected_series(events, keys):
    """(keys, week) -> cost, contribution and their running sums, in cents and quarter cents."""
    sums = defaultdict(lambda: [0, 0])
    for event in events:
        cell = sums[tuple(event.get(key) for key in keys), event["week"]]
        cell[0] += int(event.get("cost", 0) * 100)
        cell[1] += int(event.get("money_in_the_bank_paid_to_us", 0) * 100)
    running = defaultdict(lambda: [0, 0])
    out = {}
    for (group, when), (spent, earned) in sorted(sums.items(), key=lambda item: item[0][1]):
        running[group][0] += spent
        running[group][1] += earned
        cost, contribution = running[group][0] / 100, running[group][1] / 100 * 0.25
        out[(*group, when, "cum_cost")] = cost
        out[(*group, when, "cum_contribution")] = contribution
        out[(*group, when, "cum_ROI")] = contribution - cost
    return out


@pytest.mark.parametrize("keys", [["keyword"], ["keyword", "campaign_name"], ["keyword", "device"], ["device"]])
def test_series(spark, keys):
    events = random_events(1)
    found = series.cumulative(series.sum_by_week(elog(spark, *events), *keys), *keys)
    assert {tuple(row[c] for c in [*keys, "week", "type"]): row.value for row in found.collect()} == expected_series(events, keys)


def test_overall_series_ends_at_the_totals(spark):
    events = random_events(2)
    found = series.overall_performance_over_time(elog(spark, *events))
    assert found.columns == ["week", "type", "value"]
    last = {row.type: row.value for row in found.filter(found.week == week(11)).collect()}
    cost = sum(int(event.get("cost", 0) * 100) for event in events) / 100
    contribution = sum(int(event.get("money_in_the_bank_paid_to_us", 0) * 100) for event in events) / 100 * 0.25
    assert last == {"cum_cost": cost, "cum_contribution": contribution, "cum_ROAS": contribution - cost}
    assert found.count() == 3 * 12


def test_series_from_weekly_totals_are_the_same(spark):
    log = elog(spark, *random_events(3))
    weekly = series.weekly_totals(log)
    for build in (
        series.overall_performance_over_time,
        series.keywords_performance_over_time,
        series.keywords_campaign_performance_over_time,
        series.device_performance_over_time,
        series.display_device_performance,
    ):
        assert rows(build(weekly)) == rows(build(log))


def test_earning_keywords_by_window_and_by_join_agree(spark):
    events = random_events(4) + [dict(keyword="idle", week=week(0), cost=Decimal("5.00"))]
    log = elog(spark, *events)
    by_join = series.cumulative(series.sum_by_week(series.earning_keywords_only(log), "keyword"), "keyword")
    assert rows(series.keywords_performance_over_time(log)) == rows(by_join)
    assert "idle" not in {row.keyword for row in by_join.collect()}


def expected_cohorts(events):
    """Row by row: (week number, cohort week, cost cents, earned cents) of one keyword."""
    mine = [event for event in events if event["keyword"] == "k"]
    number = {when: i + 1 for i, when in enumerate(sorted({event["week"] for event in mine}))}
    first = {}
    for event in mine:
        user = event.get("user_id")
        if user is not None:
            first[user] = min(first.get(user, 99), number[event["week"]])
    return [
        (
            number[event["week"]],
            first[event["user_id"]] if event.get("user_id") is not None else number[event["week"]],
            int(event.get("cost", 0) * 100),
            int(event.get("money_in_the_bank_paid_to_us", 0) * 100),
        )
        for event in mine
    ]


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_cohorts(spark, seed):
    events = random_events(seed)
    log, placed = elog(spark, *events), expected_cohorts(events)

    assigned = cohorts.cohort_assignment(log, "k")
    assert rows(assigned, "week_number", "cohort_week") == sorted(
        ((n, c) for n, c, _, _ in placed), key=lambda pair: tuple((False, str(v)) for v in pair)
    )
    assert all(row.cohort == f"cohort_{row.cohort_week}" for row in assigned.collect())

    totals = defaultdict(lambda: [0, 0])
    weekly = defaultdict(lambda: [0, 0])
    for n, c, spent, earned in placed:
        for cell in (totals[c], weekly[c, n]):
            cell[0] += spent
            cell[1] += earned
    found = cohorts.cohort_totals(log, "k").collect()
    assert [(row.cohort_week, row.type) for row in found] == [
        (c, kind) for c in sorted(totals) for kind in ("cohort_cost", "cohort_contribution")
    ]
    for row in found:
        cost, contribution = totals[row.cohort_week][0] / 100, totals[row.cohort_week][1] / 100 * 0.25
        assert row.value == (-cost if row.type == "cohort_cost" else contribution)
        assert row.cohort_ROI == contribution - cost

    by_cohort = defaultdict(list)
    for (c, n), (spent, earned) in sorted(weekly.items()):
        before = by_cohort[c][-1] if by_cohort[c] else (0, 0, 0)
        by_cohort[c].append((n, before[1] + spent, before[2] + earned))
    expected = {}
    for c, line in by_cohort.items():
        values = [(n, earned / 100 * 0.25 - spent / 100) for n, spent, earned in line]
        crossed = [
            n for i, (n, value) in enumerate(values) if value > 0 and (i == 0 or values[i - 1][1] < 0)
        ]
        weeks = crossed[0] - values[0][0] + 1 if crossed else None
        expected |= {(c, n): (value, int(n in crossed), weeks) for n, value in values}
    even = cohorts.cohort_breakeven(log, "k").collect()
    assert {(r.cohort_week, r.week_number): (r.value, r.breakeven_week, r.weeks_until_breakeven) for r in even} == expected


def test_breakeven_from_zero_is_no_crossing(spark):
    log = elog(
        spark,
        dict(keyword="k", week=week(0), user_id=1, money_in_the_bank_paid_to_us=Decimal("0.00")),
        dict(keyword="k", week=week(2), user_id=1, money_in_the_bank_paid_to_us=Decimal("8.00")),
        dict(keyword="k", week=week(1), cost=Decimal("1.00")),
        dict(keyword="k", week=week(1), user_id=2, money_in_the_bank_paid_to_us=Decimal("1.00")),
        dict(keyword="k", week=week(2), user_id=2, money_in_the_bank_paid_to_us=Decimal("40.00")),
    )
    found = rows(cohorts.cohort_breakeven(log, "k"), "cohort_week", "week_number", "value", "breakeven_week", "weeks_until_breakeven")
    assert found == [(1, 1, 0.0, 0, None), (1, 3, 2.0, 0, None), (2, 2, -0.75, 0, 2), (2, 3, 9.25, 1, 2)]


def test_week_ordinal_follows_the_calendar(spark):
    log = elog(spark, dict(keyword="k", week=week(5)), dict(keyword="k", week=week(1)), dict(keyword="x", week=week(0)))
    assert rows(cohorts.week_ordinal(log, "k")) == [(week(1), 1), (week(5), 2)]
    assert rows(cohorts.week_ordinal(log)) == [(week(0), 1), (week(1), 2), (week(5), 3)]
