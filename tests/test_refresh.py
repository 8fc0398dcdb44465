import datetime as dt

import pytest
from pyspark.sql import types as T
from samples import line, order, rate, visit, write

from turnstile.operators import snapshot
from turnstile.operators.screen import query_log_screen
from turnstile.operators.upsert import TableAssertion
from turnstile.plans.answers import DATASET, LOG, PROJECT
from turnstile.plans.measures import measures, register_views
from turnstile.plans.refresh import Warehouse, refresh
from turnstile.sources import landing
from turnstile.sources.tables import StoredTable, by_number

DAY1 = dt.datetime(2026, 3, 3, 9, tzinfo=dt.timezone.utc)
DAY2 = dt.datetime(2026, 3, 4, 9, tzinfo=dt.timezone.utc)


def day(i, modified="2026-03-02T20:00:00Z", **more):
    lines = [line(i * 10, rates=[rate("Adult (13-64)", 2, sub="20.00")], event=visit("2026-03-20", schedule=i, event=i), salesOfficeName="Retail")]
    return order(i, created="2026-03-02T20:00:00Z", modified=modified, lines=lines, primaryContact={"id": i, "email": "a@b.co"}, **more)


def land(spark, tmp_path, name, docs):
    target = str(tmp_path / f"{name}-landed")
    landing.backfill_load(spark, write(tmp_path / name, docs), target)
    return target


def test_loads_touch_only_their_buckets(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path), "t", T.StructType.fromDDL("k int, a string"), by_number("k", 10))

    def rows(*pairs):
        return spark.createDataFrame(pairs, "k int, a string")

    table.write(rows((1, "x"), (12, "x"), (None, "x")))
    table.write(rows((1, "y"), (2, "y")))
    assert table.loads() == [1, 2]
    assert sorted(map(tuple, table.read().collect()), key=repr) == [(1, "y"), (12, "x"), (2, "y"), (None, "x")]
    assert table.buckets(rows((3, ""), (15, ""), (None, ""))) == {"0", "1", "none"}
    assert [tuple(r) for r in table.read(buckets={"1"}).collect()] == [(12, "x")]
    # A load that was written but never published does not exist, and its number is not used again.
    rows((1, "lost")).selectExpr("*", "'0' AS bucket", "3 AS v").write.mode("append").partitionBy("bucket", "v").parquet(table.home)
    assert table.read().filter("a = 'lost'").isEmpty()
    table.write(rows((1, "z")))
    assert table.loads() == [1, 2, 4] and table.read().filter("k = 2").isEmpty()


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def test_two_days(spark, tmp_path, house):
    first = land(spark, tmp_path, "d1", [day(1), day(2)])
    assert refresh(house, first, DAY1) == {"orders": 2, "items": 2, "contact": 2, "event": 2}
    changed = day(2, modified="2026-03-03T20:00:00Z", status="Void")
    second = land(spark, tmp_path, "d2", [changed, day(3)])
    assert refresh(house, second, DAY2) == {"orders": 3, "items": 3, "contact": 3, "event": 3}
    assert {r.order_id: r.status for r in house.orders.read().collect()} == {1: "Active", 2: "Void", 3: "Active"}
    assert house.history().count() == 4
    audit = spark.read.parquet(house.audit_path)
    assert {r.table_name for r in audit.select("table_name").distinct().collect()} == {"orders", "line_items", "primary_contact", "event"}
    assert audit.select("audit_timestamp").distinct().count() == 2
    # The same batch again changes nothing.
    refresh(house, second, DAY2 + dt.timedelta(hours=1))
    assert house.history().count() == 4 and house.items.read().count() == 3

    views = measures(house, dt.date(2026, 4, 1), 2026)
    assert [tuple(r) for r in views["revenue_by_sales_channel"]().collect()] == [("Front Desk", 4, 40)]
    # History keeps both versions of order 2; the void one does not count.
    assert [tuple(r) for r in views["visitor_count_by_sales_channel"]().collect()] == [("Retail", 6)]

    register_views(house, dt.date(2026, 4, 1), 2026)
    assert spark.sql("SELECT headcount FROM vw_thirty_day_headcount").first().headcount == 6

    root = str(tmp_path / "archive")
    done = snapshot.snapshot(spark, views, dt.date(2026, 4, 1), root, "house").first()
    assert (done.archive_dataset_created, done.views_archived) == ("dashboard_archive_2026_q1", 18)
    stored = spark.read.parquet(f"{root}/dashboard_archive_2026_q1/revenue_by_sales_channel")
    assert stored.count() == 1
    meta = spark.read.parquet(f"{root}/dashboard_archive_2026_q1/snapshot_metadata").first()
    assert (meta.archive_year, meta.archive_quarter, str(meta.archive_date), meta.archived_object_count) == (2026, 1, "2026-03-31", 18)


def test_first_failure_stops_but_is_recorded(spark, tmp_path, house):
    batch = land(spark, tmp_path, "bad", [day(1, total=900.0)])
    with pytest.raises(TableAssertion, match="validation of orders"):
        refresh(house, batch, DAY1)
    assert house.event.read().count() == 1
    audit = spark.read.parquet(house.audit_path)
    assert audit.filter("severity = 'ERROR'").count() == 1
    assert {r.table_name for r in audit.collect()} == {"orders"}


def test_duplicate_grain_stops_the_load(spark, tmp_path, house):
    twin = day(1)
    twin["lineItems"] *= 2
    with pytest.raises(TableAssertion, match="line items repeat"):
        refresh(house, land(spark, tmp_path, "twin", [twin]), DAY1)
    assert house.items.read().count() == 2 and house.contact.loads() == []


@pytest.mark.parametrize("as_of, ok", [("2026-10-01", True), ("2026-09-30", False), ("2026-09-01", False)])
def test_snapshot_guard(spark, tmp_path, as_of, ok):
    run = spark.sql(f"SELECT DATE '{as_of}' AS run_date")
    assert snapshot.snapshot_guard(run).first().allowed == ok
    if not ok:
        with pytest.raises(TableAssertion, match="quarter"):
            snapshot.snapshot(spark, dict.fromkeys(snapshot.MEASURES), dt.date.fromisoformat(as_of), str(tmp_path), "x")


def test_snapshot_needs_every_measure(spark, tmp_path):
    with pytest.raises(TableAssertion, match="missing"):
        snapshot.snapshot(spark, {}, dt.date(2026, 10, 1), str(tmp_path), "x")


def test_screen(spark):
    extra = [
        ("sElEcT\n1 FROM `analytics-demo.governed.vw_event`", True),
        ("SELECT update_count FROM `analytics-demo.governed.vw_event`", True),
        ("", False),
        ("SELECT ';' FROM `analytics-demo.governed.vw_event`", False),
        ("SELECT 1 FROM `a.b.c.d`", False),
    ]
    cases = [(sql, reason is None) for sql, reason in LOG] + extra
    log = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "query_id long, sql string")
    got = [r.allowed for r in query_log_screen(log, PROJECT, DATASET).orderBy("query_id").collect()]
    assert got == [ok for _, ok in cases]


def test_latest_version_of_a_document_without_modification_time(spark, tmp_path, house):
    batch = land(spark, tmp_path, "same", [day(1, modifiedDate=None)])
    refresh(house, batch, DAY1)
    refresh(house, batch, DAY2)
    as_of = dt.date(2026, 4, 1)
    latest = measures(house, as_of, 2026, latest_only=True)["thirty_day_headcount"]().collect()
    every = measures(house, as_of, 2026)["thirty_day_headcount"]().collect()
    assert [sum(r.headcount for r in rows) for rows in (latest, every)] == [2, 4]


def test_views_follow_later_loads(spark, tmp_path, house):
    refresh(house, land(spark, tmp_path, "v1", [day(1)]), DAY1)
    register_views(house, dt.date(2026, 4, 1), 2026)
    count = lambda: spark.sql("SELECT count(*) FROM vw_orders").first()[0]
    assert count() == 1 and spark.sql("SELECT * FROM vw_total_revenue_per_visitor").count() >= 0
    refresh(house, land(spark, tmp_path, "v2", [day(2)]), DAY2)
    assert count() == 2 and spark.table("vw_primary_contact_masked").count() == 2
