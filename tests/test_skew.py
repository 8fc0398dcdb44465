"""One order, schedule and document version holds a third or more of all rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import documents, line, order, rate, visit

from turnstile.operators import event as EV
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators import questions as Q
from turnstile.operators.upsert import lacking, upsert
from turnstile.operators.views import revenue


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """400 small orders and one with 400 lines on one schedule."""
    small = [order(i, lines=[line(i, rates=[rate("Under 3", 1, sub="1.00")], event=visit("2026-03-02", schedule=i % 7, event=i % 5))], status="Active") for i in range(400)]
    big = order(1000, salesOfficeName="Retail", lines=[line(j, rates=[rate("Adult (13-64)", 2, sub="3.00")], event=visit("2026-03-01", schedule=99, event=99)) for j in range(400)])
    docs = small + [big]
    return docs, documents(spark, tmp_path_factory.mktemp("hot"), docs)


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(spark, request):
    """Both ways Spark may join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_revenue_by_channel(hot, joins):
    docs, raw = hot
    want = defaultdict(lambda: [0, 0.0])
    for d in docs:
        for li in d["lineItems"]:
            for r in li["rateTypes"]:
                want[d["salesOfficeName"]][0] += r["quantity"]
                want[d["salesOfficeName"]][1] += r["subTotal"]
    rows = revenue.revenue_by_sales_channel(O.orders_transform(raw), LI.line_items_transform(raw), 2026)
    assert {r.sales_office: [r.tickets_sold, float(r.revenue)] for r in rows.collect()} == dict(want)


def test_hot_order_reaches_the_join_as_one_row(hot):
    from turnstile.operators.views.rules import tickets_by_order

    per_order = tickets_by_order(LI.line_items_transform(hot[1]))
    assert per_order.count() == 401 and per_order.filter("order_id = 1000").first().tickets == 800


def test_event_counts_collapse_a_hot_schedule(hot):
    counts = EV.event_counts(hot[1])
    assert counts.filter("schedule_id = 99").first().lines == 400
    assert counts.count() == 36


def test_attendance_has_no_fan_out(hot, joins):
    raw = hot[1]
    event, items = EV.event_transform(raw), LI.line_items_transform(raw)
    got = {str(r.event_date): r.attendance for r in Q.attendance_by_visit_date(event, items).collect()}
    assert got["2026-03-01"] == 800


def test_anti_join_and_upsert_with_hot_keys(spark, joins):
    hot_rows = spark.range(3000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("k"), F.lit("a").alias("a"))
    assert lacking(spark.range(10).toDF("k"), hot_rows, ["k"]).count() == 9
    target = spark.range(5000).select(F.col("id").alias("k"), F.lit("b").alias("a"))
    # The hot key is new to the target, so its rows are all inserted.
    merged = upsert(target.filter("k <> 7"), hot_rows, ["k"], ["a"])
    assert merged.filter("k = 7").count() == 1500
    assert merged.filter("a = 'b'").count() == 5000 - 1 - 1500
