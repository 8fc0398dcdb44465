"""Headcounts by visit date, from document history or from its flat visits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.operators.views.rules import Visits, visits, visits_in


def monthly_headcount_by_ticket_type(
    hist: Visits, year: int, latest_only: bool = False
) -> DataFrame:
    return (
        visits_in(hist, year, latest_only)
        .groupBy(clock.month_start(F.col("visit_date")).alias("visit_month_date"), "ticket_type")
        .agg(F.sum("quantity").alias("headcount"))
        .select(
            "visit_month_date",
            clock.month_label(F.col("visit_month_date")).alias("visit_month"),
            "ticket_type",
            "headcount",
        )
        .orderBy("visit_month_date", "ticket_type")
    )


def visitor_count_by_sales_channel(
    hist: Visits, year: int, latest_only: bool = False
) -> DataFrame:
    """Grouped by the line item's own office, not the order's."""
    return (
        visits_in(hist, year, latest_only)
        .groupBy("sales_office")
        .agg(F.sum("quantity").alias("visitor_count"))
        .orderBy(F.desc("visitor_count"), "sales_office")
    )


def headcount_before(
    hist: Visits, as_of: dt.date, days: int, latest_only: bool = False
) -> DataFrame:
    """Visitors on each of the given number of days before ``as_of``; empty days are absent."""
    first, last = as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)
    return (
        visits(hist, first, last, latest_only)
        .groupBy("visit_date")
        .agg(F.sum("quantity").alias("headcount"))
        .orderBy("visit_date")
    )


def yesterdays_tickets_sold(
    hist: Visits, as_of: dt.date, latest_only: bool = False
) -> DataFrame:
    return headcount_before(hist, as_of, 1, latest_only)


def seven_day_headcount(hist: Visits, as_of: dt.date, latest_only: bool = False) -> DataFrame:
    return headcount_before(hist, as_of, 7, latest_only)


def thirty_day_headcount(hist: Visits, as_of: dt.date, latest_only: bool = False) -> DataFrame:
    return headcount_before(hist, as_of, 30, latest_only)
