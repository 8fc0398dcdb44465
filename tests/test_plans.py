"""What the optimizer makes of stored tables and documents."""

import datetime as dt
import re

import pytest
from samples import documents, line, order, rate, visit

from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.views import attendance, membership, revenue, transactions
from turnstile.plans import registry
from turnstile.sources import landing
from turnstile.sources import schema as S


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Normalised tables and history on disk."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    home = tmp_path_factory.mktemp("stored")
    raw = documents(spark, home / "json", [order(1, lines=[line(1, rates=[rate("Group")], event=visit("2026-03-01"))])])
    O.orders_transform(raw).write.parquet(f"{home}/orders")
    LI.line_items_transform(raw).write.parquet(f"{home}/items")
    raw.selectExpr("*", "current_timestamp() AS ingestion_timestamp", "current_date() AS ingestion_date").write.parquet(f"{home}/hist")
    return str(home)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"ReadSchema: (struct<.*)", text)


def test_date_range_is_pushed_as_instants(spark, stored):
    df = transactions.refund_void_rate(spark.read.parquet(f"{stored}/orders"), 2026)
    text = plan(df)
    assert "GreaterThanOrEqual(created_date,2026-01-01 08:00:00.0)" in text
    assert "LessThan(created_date,2027-01-01 08:00:00.0)" in text
    assert scans(text) == ["struct<created_date:timestamp,status:string>"]


def test_measures_read_only_their_columns(spark, stored):
    orders, items = (spark.read.parquet(f"{stored}/{t}") for t in ("orders", "items"))
    text = plan(revenue.revenue_by_sales_channel(orders, items, 2026))
    assert "In(rate_type" in text
    read = " ".join(scans(text))
    assert "line_item_subtotal" in read and "serials" not in read and "question" not in read


def test_lines_are_combined_before_the_join(spark, stored):
    orders, items = (spark.read.parquet(f"{stored}/{t}") for t in ("orders", "items"))
    text = plan(revenue.average_daily_revenue(orders, items, 2026))
    assert re.search(r"Join.*(?s:.)*partial_sum\(line_item_subtotal", text)


@pytest.mark.parametrize(
    "measure, fields",
    [
        (lambda h: attendance.thirty_day_headcount(h, dt.date(2026, 4, 1)), S.VISIT_FIELDS),
        (lambda h: attendance.monthly_headcount_by_ticket_type(h, 2026), S.VISIT_FIELDS),
        (lambda h: membership.membership_summary(h, 2026), S.MEMBERSHIP_FIELDS),
    ],
)
def test_history_measures_read_narrow_documents(spark, stored, measure, fields):
    hist = spark.read.schema(S.narrow(S.HISTORY, fields)).parquet(f"{stored}/hist")
    text = plan(measure(hist))
    (read,) = scans(text)
    assert "rateTypes" in read
    for unwanted in ("serials", "primaryContact", "couponAmount", "questions"):
        assert unwanted not in read


def test_raw_table_narrows(spark, stored):
    docs = landing.raw_table(spark, f"{stored}/hist", LI.fields_for(LI.SALE))
    assert scans(plan(docs)) == [
        "struct<id:bigint,lineItems:array<struct<id:bigint,rateTypes:array<struct<rateType:string,"
        "subTotal:decimal(38,9),quantity:bigint>>>>>"
    ]


UNWANTED = ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
# The value median windows over a histogram of bounded size.
BOUNDED = {"transactions_value_median", "quarter_snapshot"}


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query_plan(spark, sf, name):
    """No Python, no cross join; only partial aggregates may meet in one task."""
    text = plan(registry.all_queries()[name](spark, sf))
    assert not [node for node in UNWANTED if node in text]
    lines = [] if name in BOUNDED else text.splitlines()
    for i, text in enumerate(lines):
        if "Exchange SinglePartition" in text:
            below = next(x for x in lines[i + 1 :] if "Aggregate" in x or "Scan" in x)
            assert "partial_" in below or "keys=[]" in below, text
