"""Order counts and values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, fixed, money, text
from turnstile.functions.fixed import ZONE
from turnstile.functions.median import median_few, median_many
from turnstile.operators.views.rules import sold_orders


def daily_transactions(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    return (
        sold_orders(orders, year, zone=zone)
        .groupBy("day")
        .agg(F.count_distinct("order_id").alias("transactions"))
    )


def transactions_daily_average(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    days = daily_transactions(orders, year, zone)
    return days.agg(F.round(F.avg("transactions"), 2).alias("average_daily_transactions"))


def transactions_daily_median(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    """At most 366 days enter the median."""
    return median_few(
        daily_transactions(orders, year, zone), "transactions", "median_daily_transactions"
    )


def transactions_value_average(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    return sold_orders(orders, year, "total", zone=zone).agg(
        F.round(F.avg("total"), 2).alias("average_transaction_value")
    )


def transactions_value_median(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    """One value per order: any number of them."""
    return median_many(
        sold_orders(orders, year, "total", zone=zone), "total", "median_transaction_value"
    )


def refund_void_rate(orders: DataFrame, year: int, zone: str = ZONE) -> DataFrame:
    """Orders without a status stay in the denominator."""
    dead = F.count_if(text.status_tight(F.col("status")).isin(*fixed.DEAD_STATUSES))
    every = F.count("*")
    return orders.filter(clock.in_local_year(F.col("created_date"), year, zone)).agg(
        dead.alias("refunded_or_voided_transactions"),
        every.alias("total_transactions"),
        money.ratio(dead, every, 4).alias("refund_void_rate"),
    )
