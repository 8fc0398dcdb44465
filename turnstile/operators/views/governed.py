"""What the question layer may read: masked contacts, whole tables by named column, measures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnstile.operators import event as EV
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.contact import contact_masked

__all__ = ["APPROVED", "contact_masked", "governed_event", "governed_line_items", "governed_orders"]

# Fixed value: names open to the question layer.
APPROVED = (
    "vw_primary_contact_masked",
    "vw_orders",
    "vw_line_items",
    "vw_event",
    "vw_revenue_by_sales_channel",
    "vw_membership_tabular",
    "vw_monthly_revenue_by_ticket_type",
    "vw_monthly_headcount_by_ticket_type",
    "vw_visitor_count_by_sales_channel",
    "vw_thirty_day_headcount",
)


def governed_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*O.SCHEMA.names)


def governed_line_items(items: DataFrame) -> DataFrame:
    return items.select(*LI.SCHEMA.names)


def governed_event(event: DataFrame) -> DataFrame:
    return event.select(*EV.SCHEMA.names)
