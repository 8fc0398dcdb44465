"""Flat visits by month: fed once a load, read by month, right while a load is not flattened yet."""

import datetime as dt

import pytest
from samples import line, order, rate, visit
from test_refresh import DAY1, DAY2, land

from turnstile.operators.views import attendance, revenue
from turnstile.plans.measures import measures
from turnstile.plans.refresh import Warehouse, refresh


def visiting(i, days, modified="2026-03-02T20:00:00Z", **more):
    lines = [line(i * 10 + k, rates=[rate("Adult (13-64)", 2, sub="20.00"), rate("Group", 9)], event=visit(d, schedule=i * 10 + k, event=i * 10 + k), salesOfficeName="Retail") for k, d in enumerate(days)]
    return order(i, created="2026-03-02T20:00:00Z", modified=modified, lines=lines, primaryContact={"id": i, "email": "a@b.co"}, **more)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    """Order 2 moves to another month, order 3 is voided, in a second load."""
    home = tmp_path_factory.mktemp("visits")
    out = Warehouse(spark, str(home / "house"))
    refresh(out, land(spark, home, "d1", [visiting(1, ["2026-03-20", "2026-04-02"]), visiting(2, ["2026-03-21"]), visiting(3, ["2026-03-22"])]), DAY1)
    later = "2026-03-03T20:00:00Z"
    refresh(out, land(spark, home, "d2", [visiting(2, ["2026-04-21"], later), visiting(3, ["2026-03-22"], later, status="Void")]), DAY2)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def counts(house, latest):
    year = attendance.monthly_headcount_by_ticket_type(house.visits, 2026, latest).collect()
    return {r.visit_month: r.headcount for r in year}


def test_all_versions_and_the_newest(house):
    assert counts(house, False) == {"March 2026": 6, "April 2026": 4}
    assert counts(house, True) == {"March 2026": 2, "April 2026": 4}
    for latest in (False, True):
        made = measures(house, dt.date(2026, 4, 1), 2026, latest_only=latest)
        hist = house.history()
        plain = {
            "thirty_day_headcount": attendance.thirty_day_headcount(hist, dt.date(2026, 4, 1), latest),
            "visitor_count_by_sales_channel": attendance.visitor_count_by_sales_channel(hist, 2026, latest),
            "revenue_per_visitor": revenue.revenue_per_visitor(hist, 2026, latest),
        }
        for name, df in plain.items():
            assert rows(made[name]()) == rows(df), name


def test_only_the_months_asked_for_are_read(spark, house):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    march = attendance.headcount_before(house.visits, dt.date(2026, 3, 23), 5)
    text = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(visit_month" in text and "(visit_month#" in text and "2026-03" in text
    assert rows(march) == [(dt.date(2026, 3, 20), 2), (dt.date(2026, 3, 21), 2), (dt.date(2026, 3, 22), 2)]
    assert march.agg({"headcount": "sum"}).first()[0] == 6


def test_a_load_counts_before_it_is_flattened_and_once_after(spark, house):
    before = counts(house, False), counts(house, True)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{house.visits.home}/_fed/2")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, False)  # as if the job had died before the mark
    assert house.visits.pending() == [2]
    assert (counts(house, False), counts(house, True)) == before
    house.visits.feed()
    assert house.visits.pending() == [] and (counts(house, False), counts(house, True)) == before


def test_nothing_stored(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path / "none"))
    empty.visits.feed()
    for latest in (False, True):
        assert attendance.seven_day_headcount(empty.visits, dt.date(2026, 4, 1), latest).collect() == []
        assert tuple(revenue.revenue_per_visitor(empty.visits, 2026, latest).first()) == (None, None, None)
