"""Predicates and row sets the measures share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, fixed, text
from turnstile.functions.fixed import ZONE
from turnstile.operators.unnest import unnest_lines
from turnstile.sources.history import history_latest


def live(
    status: str = "status",
    form: Callable[[Column], Column] = text.status_plain,
    dead: Sequence[str] = fixed.DEAD_STATUSES,
) -> Column:
    """Status that counts as a sale. A NULL status is neither in nor out: the row goes."""
    return ~form(F.col(status)).isin(*dead)


def is_ticket(rate_type: str = "rate_type") -> Column:
    return F.col(rate_type).isin(*fixed.TICKET_TYPES)


def sold_orders(
    orders: DataFrame,
    year: int,
    *columns: str,
    zone: str = ZONE,
    dead: Sequence[str] = fixed.DEAD_STATUSES,
) -> DataFrame:
    """Live orders of a local year with their local day."""
    return orders.filter(clock.in_local_year(F.col("created_date"), year, zone) & live(dead=dead)).select(
        "order_id", clock.local_date(F.col("created_date"), zone).alias("day"), *columns
    )


def tickets_by_order(items: DataFrame, *extra: str) -> DataFrame:
    """Ticket lines summed per order before any join.

    Partial sums run map-side, so an order with a third of all lines reaches the
    join as one row (one per extra key); sums over the join stay the same.
    """
    return items.filter(is_ticket()).groupBy("order_id", *extra).agg(
        F.sum("line_item_quantity").alias("tickets"), F.sum("line_item_subtotal").alias("amount")
    )


class StoredVisits(Protocol):
    """Admitted tickets kept flat; see sources.visits."""

    def between(self, first: dt.date, last: dt.date, latest_only: bool) -> DataFrame: ...


#: Document history, or the tickets flattened from it.
Visits = DataFrame | StoredVisits


def visits(source: Visits, first: dt.date, last: dt.date, latest_only: bool = False) -> DataFrame:
    """Admitted tickets by visit date on the days first to last.

    All stored versions count, as in the source measures; ``latest_only`` keeps the
    newest version of each order.
    """
    if not isinstance(source, DataFrame):
        return source.between(first, last, latest_only)
    docs = history_latest(source) if latest_only else source
    return flat_visits(docs, lambda day: day.between(F.lit(first), F.lit(last)))


def visits_in(source: Visits, year: int, latest_only: bool = False) -> DataFrame:
    return visits(source, dt.date(year, 1, 1), dt.date(year, 12, 31), latest_only)


def flat_visits(
    docs: DataFrame, when: Callable[[Column], Column] = Column.isNotNull, keep: Sequence[str] = ()
) -> DataFrame:
    """Admitted tickets of documents, with the named document fields.

    Each filter runs at the level it belongs to, before the next unnest.
    """
    lines = unnest_lines(docs.filter(live()), *keep, outer=False)
    day = F.col("li.event.schedule.date").cast("date")
    lines = lines.filter((F.col("li.type") == "Rate") & when(day))
    rates = lines.select(
        *keep,
        day.alias("visit_date"),
        F.col("li.salesOfficeName").alias("sales_office"),
        F.explode("li.rateTypes").alias("ra"),
    )
    return rates.filter(is_ticket("ra.rateType")).select(
        *keep,
        "visit_date",
        "sales_office",
        F.col("ra.rateType").alias("ticket_type"),
        F.col("ra.quantity").alias("quantity"),
        F.col("ra.subTotal").alias("amount"),
    )
