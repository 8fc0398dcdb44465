"""Nested orders to rows. Positions give each element a repeatable identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest_lines(raw: DataFrame, *keep: str, outer: bool = True) -> DataFrame:
    """One row per line item (``li``), plus one per order without any when ``outer``.

    A missing array counts as an empty one. Written as an expression it also keeps
    Catalyst from adding a size filter that would evaluate a computed array twice.
    """
    spread = F.posexplode_outer if outer else F.posexplode
    lines = F.coalesce(F.col("lineItems"), F.array().cast(raw.schema["lineItems"].dataType))
    return raw.select(*keep, spread(lines).alias("line_pos", "li"))


def unnest_line_rates(raw: DataFrame, *keep: str, outer: bool = True) -> DataFrame:
    """One row per rate entry (``ra``) of each line item."""
    spread = F.posexplode_outer if outer else F.posexplode
    lines = unnest_lines(raw, *keep, outer=outer)
    return lines.select(*keep, "line_pos", "li", spread("li.rateTypes").alias("rate_pos", "ra"))


def _scheduled(raw: DataFrame) -> DataFrame:
    """Lines with any schedule field.

    The filter rejects lines without a schedule, so the inner unnest is equal to the
    outer one and drops empty orders before the rows are made.
    """
    some = F.lit(False)
    for part in ("id", "date", "startTime", "endTime"):
        some = some | F.col(f"li.event.schedule.{part}").isNotNull()
    return unnest_lines(raw, "id", outer=False).filter(some)


def _schedule_columns() -> list[Column]:
    at = "li.event.schedule"
    return [
        F.col(f"{at}.id").alias("schedule_id"),
        F.col(f"{at}.date").cast("date").alias("event_date"),
        F.col(f"{at}.startTime").cast("timestamp").alias("event_start"),
        F.col(f"{at}.endTime").cast("timestamp").alias("event_end"),
        F.col("li.event.id").alias("event_id"),
    ]


def unnest_schedules(raw: DataFrame) -> DataFrame:
    """Schedule identity and event id, for checks that need no more."""
    return _scheduled(raw).select(*_schedule_columns())


def unnest_events(raw: DataFrame) -> DataFrame:
    """Every event field of each scheduled line."""
    return _scheduled(raw).select(
        *_schedule_columns(),
        F.col("li.event.type").alias("event_type"),
        F.col("li.event.name").alias("event_name"),
        F.col("id").alias("order_id"),
    )


def unnest_rates(raw: DataFrame, outer: bool = True) -> DataFrame:
    """Orders without lines and lines without rates stay as rows of NULLs when ``outer``."""
    return unnest_line_rates(raw, "id", outer=outer).select(
        F.col("id").alias("order_id"),
        F.col("li.id").alias("line_item_id"),
        F.col("li.type").alias("line_item_type"),
        F.col("li.name").alias("line_item_name"),
        F.col("ra.rateType").alias("rate_type"),
        F.col("ra.quantity").alias("quantity"),
        F.col("ra.subTotal").alias("subtotal"),
    )
