"""Business questions over the governed tables and measures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.functions.fixed import ZONE
from turnstile.operators.views.revenue import ticket_lines_by_order
from turnstile.operators.views.rules import live


def valid(orders: DataFrame) -> DataFrame:
    """Orders that count as a transaction, whatever blanks their status holds."""
    return orders.filter(live(form=text.status_tight))


def _round(total: Column, name: str) -> Column:
    return F.round(total, 2).alias(name)


def _same_text(column: str, value: str) -> Column:
    return F.lower(text.trim_ws(F.col(column))) == value.strip().lower()


def ticket_revenue(
    orders: DataFrame, items: DataFrame, start: dt.date, end: dt.date, zone: str = ZONE
) -> DataFrame:
    """Official ticket revenue: ticket line types of orders with status exactly Active."""
    active = orders.filter(
        (F.col("status") == "Active") & clock.on_local_days(F.col("created_date"), start, end, zone)
    ).select("order_id")
    return active.join(ticket_lines_by_order(items), "order_id").agg(
        _round(F.sum("amount"), "ticket_revenue")
    )


def revenue_quarter(orders: DataFrame, year: int, quarter: int, zone: str = ZONE) -> DataFrame:
    start, end = clock.quarter_bounds(year, quarter)
    rows = valid(orders).filter(clock.on_local_days(F.col("created_date"), start, end, zone))
    return rows.agg(_round(F.sum("total"), "total_revenue"))


def _quarter_of(view: DataFrame, month: str, year: int, quarter: int) -> DataFrame:
    start, end = clock.quarter_bounds(year, quarter)
    return view.filter((F.col(month) >= F.lit(start)) & (F.col(month) < F.lit(end)))


def ticket_revenue_quarter(monthly: DataFrame, year: int, quarter: int) -> DataFrame:
    """From the monthly measure, which follows its own status rule."""
    rows = _quarter_of(monthly, "revenue_month_date", year, quarter)
    return rows.agg(_round(F.sum("revenue"), "total_ticket_revenue"))


def headcount_quarter(monthly: DataFrame, ticket_type: str, year: int, quarter: int) -> DataFrame:
    rows = _quarter_of(monthly, "visit_month_date", year, quarter)
    return rows.filter(F.col("ticket_type") == ticket_type).agg(
        F.sum("headcount").alias("total_headcount")
    )


def office_revenue(channel: DataFrame, office: str) -> DataFrame:
    return channel.filter(_same_text("sales_office", office)).select(
        F.round("revenue", 2).alias("total_revenue")
    )


def office_tickets(channel: DataFrame, office: str) -> DataFrame:
    return channel.filter(_same_text("sales_office", office)).select("tickets_sold")


def office_visitors(visitors: DataFrame, office: str) -> DataFrame:
    return visitors.filter(_same_text("sales_office", office)).select("visitor_count")


def top_membership(tabular: DataFrame) -> DataFrame:
    return (
        tabular.select("membership_name", "membership_revenue")
        .orderBy(F.desc_nulls_last("membership_revenue"), "membership_name")
        .limit(1)
    )


def thirty_day_stats(headcounts: DataFrame) -> DataFrame:
    """Total, mean and busiest day (the earliest on a tie)."""
    best = F.min_by("visit_date", F.struct(-F.col("headcount"), F.col("visit_date")))
    return headcounts.agg(
        F.sum("headcount").alias("total_headcount"),
        F.round(F.avg("headcount"), 2).alias("average_daily_headcount"),
        best.alias("best_day"),
        F.max("headcount").alias("best_headcount"),
    )


def orders_yesterday(orders: DataFrame, as_of: dt.date, zone: str = ZONE) -> DataFrame:
    day = as_of - dt.timedelta(days=1)
    return orders.filter(clock.on_local_days(F.col("created_date"), day, as_of, zone)).agg(
        F.count_distinct("order_id").alias("orders")
    )


def orders_by_city(contact: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per city of known contacts. Only distinct orders count, so both sides are cut first."""
    known = contact.filter("not is_unknown_contact").select("order_id", "city").distinct()
    return (
        known.join(orders.select("order_id").distinct(), "order_id", "left_semi")
        .groupBy("city")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), "city")
    )


def attendance_by_visit_date(event: DataFrame, items: DataFrame) -> DataFrame:
    """Tickets per visit date without fan-out.

    Events are cut to one row per order and date and lines summed per order before
    they meet, so neither side multiplies the other. The event table keeps one order
    of each schedule, and the counts cover those orders.
    """
    days = event.select("order_id", "event_date").distinct()
    per_order = items.groupBy("order_id").agg(F.sum("line_item_quantity").alias("quantity"))
    return (
        days.join(per_order, "order_id")
        .groupBy("event_date")
        .agg(F.sum("quantity").alias("attendance"))
        .orderBy("event_date")
    )


def orders_per_event(event: DataFrame) -> DataFrame:
    """Distinct orders per event name, of the one order each schedule keeps."""
    return event.groupBy("event_name").agg(F.count_distinct("order_id").alias("orders"))


def orders_per_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.count_distinct("order_id").alias("orders"))


def event_duration(event: DataFrame) -> DataFrame:
    minutes = F.timestamp_diff("MINUTE", "event_start", "event_end")
    return event.select(
        "event_id", "event_name", "schedule_id", "event_start", minutes.alias("duration_minutes")
    )


def revenue_by_product_safe(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Value of the valid orders that hold a product, each order once per product."""
    held = items.select("order_id", "product_id").distinct()
    return (
        held.join(valid(orders).select("order_id", "total"), "order_id")
        .groupBy("product_id")
        .agg(F.count("*").alias("orders"), _round(F.sum("total"), "order_total"))
    )


def _order_totals(orders: DataFrame, *by: str) -> DataFrame:
    return valid(orders).groupBy(*by).agg(
        F.count_distinct("order_id").alias("orders"), _round(F.sum("total"), "total_revenue")
    )


def web_orders(orders: DataFrame) -> DataFrame:
    """Web orders beside the office of the same flavour: the two are not the same thing."""
    online = (F.col("salesoffice_name") == "Online Sales").alias("online_office")
    return _order_totals(orders.select("*", online), "web_order", "online_office")


def revenue_by_currency(orders: DataFrame) -> DataFrame:
    return _order_totals(orders, "currency")


def revenue_by_employee(orders: DataFrame) -> DataFrame:
    return _order_totals(
        orders, "sales_person_id", "sales_person_firstname", "sales_person_lastname"
    )


BREAKDOWN = (
    "rate_type",
    "line_item_id",
    "line_item_quantity",
    "coupon_amount",
    "line_item_tax_total",
)


def rate_type_breakdown(items: DataFrame) -> DataFrame:
    return items.groupBy("rate_type").agg(
        F.count_distinct("line_item_id").alias("line_items"),
        F.sum("line_item_quantity").alias("tickets"),
        _round(F.sum("coupon_amount"), "coupons"),
        _round(F.sum("line_item_tax_total"), "tax"),
    )


# Fixed value: most rows a detail answer may hold.
DETAIL_ROWS = 500


def order_detail(orders: DataFrame) -> DataFrame:
    """The newest valid orders, named columns only."""
    return (
        valid(orders)
        .select("order_id", "created_date", "salesoffice_name", "status", "total", "currency")
        .orderBy(F.desc("created_date"), "order_id")
        .limit(DETAIL_ROWS)
    )
