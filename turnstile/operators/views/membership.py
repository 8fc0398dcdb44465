"""Membership measures, from document history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text
from turnstile.functions.fixed import ZONE
from turnstile.operators.unnest import unnest_lines
from turnstile.operators.views.rules import live
from turnstile.sources.history import history_latest


def memberships(
    hist: DataFrame, year: int, zone: str = ZONE, latest_only: bool = False
) -> DataFrame:
    """Membership rate entries of live orders; lines without rates stay, with NULL amounts."""
    docs = history_latest(hist) if latest_only else hist
    docs = docs.filter(
        clock.in_local_year(F.col("createdDate"), year, zone) & live(form=text.status_tight)
    )
    lines = unnest_lines(docs, "id", outer=False).filter(F.col("li.type") == "Membership")
    rates = lines.select(
        F.col("id").alias("order_id"),
        text.trim_ws(F.col("li.name")).alias("name"),
        F.explode_outer("li.rateTypes").alias("ra"),
    )
    return rates.select(
        "order_id", "name", F.col("ra.quantity").alias("quantity"), F.col("ra.subTotal").alias("amount")
    )


def _starts(*prefixes: str) -> Column:
    name = F.col("name")
    hit = name.startswith(prefixes[0])
    for p in prefixes[1:]:
        hit = hit | name.startswith(p)
    return hit


def membership_summary(
    hist: DataFrame, year: int, zone: str = ZONE, latest_only: bool = False
) -> DataFrame:
    staff = _starts("Volunteer", "Employee")
    zero = F.lit(0)
    return memberships(hist, year, zone, latest_only).agg(
        F.sum(F.when(_starts("New "), F.col("quantity")).otherwise(zero)).alias(
            "new_memberships_sold"
        ),
        F.sum(F.when(~(_starts("New ") | staff), F.col("quantity")).otherwise(zero)).alias(
            "membership_renewals"
        ),
        F.round(F.sum(F.when(~staff, F.col("amount")).otherwise(zero)), 2).alias(
            "membership_revenue"
        ),
    )


def membership_tabular(
    hist: DataFrame, year: int, zone: str = ZONE, latest_only: bool = False
) -> DataFrame:
    """Staff and volunteer memberships are not left out here."""
    return (
        memberships(hist, year, zone, latest_only)
        .groupBy(F.col("name").alias("membership_name"))
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("memberships_sold"),
            F.round(F.sum("amount"), 2).alias("membership_revenue"),
        )
        .orderBy(F.desc("memberships_sold"), "membership_name")
    )
