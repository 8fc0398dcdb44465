"""Checks that are run by hand or on a schedule, outside the load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import fixed
from turnstile.operators.upsert import duplicates, lacking


def orphans(
    orders: DataFrame, items: DataFrame, contact: DataFrame, event: DataFrame
) -> DataFrame:
    """Rows of each child table whose order is not stored."""
    found = [
        lacking(child.select(F.lit(name).alias("table_name"), "order_id"), orders, ["order_id"])
        for name, child in (("line_items", items), ("primary_contact", contact), ("event", event))
    ]
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("table_name")
        .agg(F.count("*").alias("orphan_rows"), F.count_distinct("order_id").alias("missing_orders"))
    )


def surrogate_duplicates(items: DataFrame, contact: DataFrame, event: DataFrame) -> DataFrame:
    """Surrogate keys in use more than once, per table."""
    keys = {
        "line_items": (items, "surrogate_key"),
        "primary_contact": (contact, "contact_surrogate_key"),
        "event": (event, "event_surrogate_key"),
    }
    found = [
        duplicates(df, [key], "duplicate_count").select(
            F.lit(name).alias("table_name"), F.col(key).alias("surrogate_key"), "duplicate_count"
        )
        for name, (df, key) in keys.items()
    ]
    return reduce(DataFrame.unionByName, found)


def monitor(contact: DataFrame, hist: DataFrame) -> DataFrame:
    """Unknown contacts and stored versions, one row per measure."""
    unknown = contact.agg(F.count_if("is_unknown_contact").alias("value"))
    stored = hist.agg(F.count("*").alias("value"))
    return unknown.select(F.lit("unknown_contacts").alias("measure"), "value").unionByName(
        stored.select(F.lit("historical_records").alias("measure"), "value")
    )


def reconcile(monthly: DataFrame, channel: DataFrame) -> DataFrame:
    """Total of the monthly measure against the channel measure.

    They differ by refunded orders, which only the monthly measure leaves out.
    """
    both = monthly.agg(F.sum("revenue").alias("monthly")).select(
        "monthly", F.lit(None).cast("decimal(38,9)").alias("channel")
    ).unionByName(
        channel.agg(F.sum("revenue").alias("channel")).select(
            F.lit(None).cast("decimal(38,9)").alias("monthly"), "channel"
        )
    )
    m, c = F.max("monthly"), F.max("channel")
    return both.agg(
        m.alias("monthly_revenue"), c.alias("channel_revenue"), (c - m).alias("difference")
    )


def domain(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Ticket types and offices outside the known lists, with row counts."""
    types = items.groupBy(F.col("rate_type").alias("value")).agg(F.count("*").alias("rows"))
    offices = orders.groupBy(F.col("salesoffice_name").alias("value")).agg(F.count("*").alias("rows"))
    return (
        types.filter(~F.col("value").isin(*fixed.TICKET_TYPES))
        .select(F.lit("ticket_type").alias("domain"), "value", "rows")
        .unionByName(
            offices.filter(~F.col("value").isin(*fixed.SALES_OFFICES)).select(
                F.lit("sales_office").alias("domain"), "value", "rows"
            )
        )
    )
