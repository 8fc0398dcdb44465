"""Revenue measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, fixed, money
from turnstile.functions.fixed import ZONE
from turnstile.functions.median import median_few
from turnstile.operators.views.rules import Visits, sold_orders, tickets_by_order, visits_in


def daily_revenue(orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    return (
        sold_orders(orders, year, zone=zone)
        .join(tickets_by_order(items), "order_id")
        .groupBy("day")
        .agg(F.sum("amount").alias("revenue"))
    )


def average_daily_revenue(
    orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE
) -> DataFrame:
    days = daily_revenue(orders, items, year, zone)
    return days.agg(F.round(F.avg("revenue"), 2).alias("average_daily_revenue"))


def median_daily_revenue(
    orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE
) -> DataFrame:
    """At most 366 days enter the median."""
    return median_few(daily_revenue(orders, items, year, zone), "revenue", "median_daily_revenue")


def monthly_revenue_by_ticket_type(
    orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE
) -> DataFrame:
    """Refunded orders are left out here, unlike in the other revenue measures."""
    sold = sold_orders(orders, year, zone=zone, dead=fixed.DEAD_OR_REFUNDED)
    month = clock.month_start(F.col("day"))
    return (
        sold.select("order_id", month.alias("revenue_month_date"))
        .join(tickets_by_order(items, "rate_type"), "order_id")
        .groupBy("revenue_month_date", F.col("rate_type").alias("ticket_type"))
        .agg(F.sum("tickets").alias("tickets_sold"), F.sum("amount").alias("revenue"))
        .select(
            "revenue_month_date",
            clock.month_label(F.col("revenue_month_date")).alias("revenue_month"),
            "ticket_type",
            "tickets_sold",
            "revenue",
        )
        .orderBy("revenue_month_date", "ticket_type")
    )


def revenue_by_sales_channel(
    orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE
) -> DataFrame:
    return (
        sold_orders(orders, year, F.col("salesoffice_name").alias("sales_office"), zone=zone)
        .join(tickets_by_order(items), "order_id")
        .groupBy("sales_office")
        .agg(F.sum("tickets").alias("tickets_sold"), F.sum("amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "sales_office")
    )


def revenue_per_visitor(hist: Visits, year: int, latest_only: bool = False) -> DataFrame:
    days = (
        visits_in(hist, year, latest_only)
        .groupBy("visit_date")
        .agg(F.sum("quantity").alias("visitors"), F.sum("amount").alias("revenue"))
    )
    total, people = F.sum("revenue"), F.sum("visitors")
    return days.agg(
        F.round(total, 2).alias("total_revenue"),
        people.alias("total_visitors"),
        money.ratio(total, people, 2).alias("revenue_per_visitor"),
    )


def monthly_ticket_revenue(
    orders: DataFrame, items: DataFrame, year: int, zone: str = ZONE
) -> DataFrame:
    """Official ticket revenue per local month: ticket line types of active orders."""
    active = orders.filter(
        (F.col("status") == "Active") & clock.in_local_year(F.col("created_date"), year, zone)
    ).select(
        "order_id",
        clock.month_start(clock.local_date(F.col("created_date"), zone)).alias("revenue_month_date"),
    )
    return (
        active.join(ticket_lines_by_order(items), "order_id")
        .groupBy("revenue_month_date")
        .agg(F.sum("amount").alias("ticket_revenue"))
        .select(
            "revenue_month_date",
            clock.month_label(F.col("revenue_month_date")).alias("revenue_month"),
            "ticket_revenue",
        )
        .orderBy("revenue_month_date")
    )


def ticket_lines_by_order(items: DataFrame) -> DataFrame:
    """Subtotal of ticket line types per order, combined before the join."""
    return (
        items.filter(F.col("line_item_type").isin(*fixed.TICKET_LINE_TYPES))
        .groupBy("order_id")
        .agg(F.sum("line_item_subtotal").alias("amount"))
    )
