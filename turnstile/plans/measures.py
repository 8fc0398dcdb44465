"""All measures over one installation's stored tables, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.functions.fixed import ZONE
from turnstile.operators.views import attendance, governed, membership, revenue, transactions
from turnstile.plans.refresh import Warehouse
from turnstile.sources import schema as S


def measures(
    warehouse: Warehouse, as_of: dt.date, year: int, zone: str = ZONE, latest_only: bool = False
) -> dict[str, Callable[[], DataFrame]]:
    """Name -> lazy DataFrame; each call reads the tables as they are then."""
    w = warehouse

    def sold(measure):
        def make():
            orders = w.orders.read()
            # Only the buckets that hold orders of the year are read of the larger table.
            held = w.orders.buckets(
                orders.filter(clock.in_local_year(F.col("created_date"), year, zone))
            )
            return measure(orders, w.items.read(buckets=held), year, zone)

        return make

    def placed(measure):
        return lambda: measure(w.orders.read(), year, zone)

    def visited(measure, when):
        return lambda: measure(w.visits, when, latest_only)

    def joined(measure):
        return lambda: measure(w.history(S.MEMBERSHIP_FIELDS), year, zone, latest_only)

    return {
        "average_daily_revenue": sold(revenue.average_daily_revenue),
        "median_daily_revenue": sold(revenue.median_daily_revenue),
        "monthly_revenue_by_ticket_type": sold(revenue.monthly_revenue_by_ticket_type),
        "monthly_ticket_revenue": sold(revenue.monthly_ticket_revenue),
        "revenue_by_sales_channel": sold(revenue.revenue_by_sales_channel),
        "revenue_per_visitor": visited(revenue.revenue_per_visitor, year),
        "transactions_daily_average": placed(transactions.transactions_daily_average),
        "transactions_daily_median": placed(transactions.transactions_daily_median),
        "transactions_value_average": placed(transactions.transactions_value_average),
        "transactions_value_median": placed(transactions.transactions_value_median),
        "refund_void_rate": placed(transactions.refund_void_rate),
        "monthly_headcount_by_ticket_type": visited(
            attendance.monthly_headcount_by_ticket_type, year
        ),
        "visitor_count_by_sales_channel": visited(attendance.visitor_count_by_sales_channel, year),
        "yesterdays_tickets_sold": visited(attendance.yesterdays_tickets_sold, as_of),
        "seven_day_headcount": visited(attendance.seven_day_headcount, as_of),
        "thirty_day_headcount": visited(attendance.thirty_day_headcount, as_of),
        "membership_summary": joined(membership.membership_summary),
        "membership_tabular": joined(membership.membership_tabular),
    }


# Fixed value: the one view whose name is not its measure's.
VIEW_NAMES = {"revenue_per_visitor": "total_revenue_per_visitor"}


def governed_tables(warehouse: Warehouse) -> dict[str, Callable[[], DataFrame]]:
    """The tables open to the question layer, by name."""
    w = warehouse
    return {
        "primary_contact_masked": lambda: governed.contact_masked(w.contact.read()),
        "orders": lambda: governed.governed_orders(w.orders.read()),
        "line_items": lambda: governed.governed_line_items(w.items.read()),
        "event": lambda: governed.governed_event(w.event.read()),
    }


def register_views(warehouse: Warehouse, as_of: dt.date, year: int, prefix: str = "vw_") -> None:
    """Make every measure and governed table a temporary view for SQL callers.

    A view holds the files of the moment, so every later load of this warehouse
    registers them again; a load by another driver shows after the next call.
    """

    def register() -> None:
        for name, make in {**measures(warehouse, as_of, year), **governed_tables(warehouse)}.items():
            make().createOrReplaceTempView(prefix + VIEW_NAMES.get(name, name))

    register()
    warehouse.after_load[prefix] = register
