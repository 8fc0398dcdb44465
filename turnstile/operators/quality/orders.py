"""Checks on orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import fixed, money, text
from turnstile.operators.quality import names
from turnstile.operators.quality.report import (
    FrameCheck,
    KeyRows,
    KeyTotals,
    RowCheck,
    Side,
    Suite,
    Tables,
    TotalCheck,
    lacks,
    one,
    zero,
)
from turnstile.operators.upsert import duplicates, lacking


def _null_counts() -> list[Column]:
    checked = (
        "order_id",
        "created_date",
        "modified_date",
        "total",
        "subtotal",
        "tax_total",
        "discount_total",
        "gratuity_total",
    )
    return [
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked],
        F.count_if(text.blank(F.col("currency"))).alias("null_or_empty_currency"),
    ]


def price_gaps() -> dict[str, Column]:
    """How far the total is from each accepted way of building it, in cents."""
    total, sub, off, tax, tip = (
        F.col(c) for c in ("total", "subtotal", "discount_total", "tax_total", "gratuity_total")
    )
    # The tax share is rounded to the stored nine decimals like any quotient in the source.
    share = money.stored(F.try_divide(tax, F.nullif(sub, F.lit(0))))

    def gap(expected: Column) -> Column:
        return F.abs(F.round(total, 2) - F.round(expected, 2))

    return {
        "fee_residual": F.round(total - (sub + tax + tip), 2),
        "delta_model_a": gap(sub - off + tax + tip),
        "delta_model_b": gap(sub + tax + tip),
        "delta_model_d": gap(sub + tax + off + tip),
        "delta_model_e": gap(sub + tax + off - money.times(off, share)),
    }


def _mispriced() -> Column:
    """Taxed, priced orders that no model explains and no plausible fee covers."""
    gaps = price_gaps()
    fee = gaps.pop("fee_residual")
    tolerance = F.lit(fixed.TOTAL_TOLERANCE).cast("decimal(4,2)")
    low, high = (F.lit(x).cast("decimal(4,2)") for x in fixed.FEE_RANGE)
    bad = (~F.upper("status").isin(*fixed.UNPRICED_STATUSES)) & (
        F.coalesce("tax_total", F.lit(0)) > 0
    )
    for g in gaps.values():
        bad = bad & (g > tolerance)
    return bad & ~fee.between(low, high)


def _mispriced_payload() -> list[Column]:
    shown = ("order_id", "status", "subtotal", "discount_total", "tax_total", "gratuity_total", "total")
    return [*[F.col(c) for c in shown], *[c.alias(n) for n, c in price_gaps().items()]]


def raw_ids(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("order_id")).distinct()


def missing_orders(t: Tables) -> DataFrame:
    return lacking(raw_ids(t["raw"]), t["orders"], ["order_id"])


def extra_orders(t: Tables) -> DataFrame:
    """Stored orders the batch does not hold; computed but not part of the report."""
    ids = t["raw"].select(F.col("id").alias("order_id"))
    return lacking(t["orders"].select("order_id"), ids, ["order_id"])


def _without(other: str, name: str):
    def build(t: Tables) -> DataFrame:
        found = lacking(t["orders"].select("order_id"), t[other], ["order_id"])
        return found.agg(F.count("*").alias(name))

    return build


def _multi_contact(t: Tables) -> DataFrame:
    return duplicates(t["contact"], ["order_id"]).agg(
        F.count("*").alias("orders_with_multiple_primary_contacts")
    )


def _amount() -> Column:
    return F.sum(F.coalesce("total", F.lit(0))).alias("total_amount")


def _rollup() -> list[Column]:
    return [
        F.count("*").alias("n_orders"),
        *[
            F.sum(F.coalesce(c, F.lit(0))).alias(f"sum_{c}")
            for c in ("total", "subtotal", "tax_total", "gratuity_total", "discount_total")
        ],
    ]


def _order_id() -> list[Column]:
    return [F.col("order_id")]


def _status_norm() -> list[Column]:
    return [text.status_spaced(F.col("status")).alias("status_norm")]


def _known_total() -> Column:
    return F.coalesce("total", F.lit(0))


def _cnt() -> list[Column]:
    return [F.col("n0").alias("cnt")]


def _n_and_amount() -> list[Column]:
    return [F.col("n0").alias("n"), F.col("amount").alias("total_amount")]


SUITE = Suite(
    "orders",
    names.ORDERS,
    {
        "nulls": TotalCheck("orders", _null_counts),
        "duplicates": FrameCheck(lambda t: duplicates(t["orders"], ["order_id"])),
        "timestamps": RowCheck(
            "orders",
            lambda: F.col("modified_date") < F.col("created_date"),
            lambda: [F.col(c) for c in ("order_id", "created_date", "modified_date")],
        ),
        "currency": RowCheck(
            "orders",
            lambda: ~F.col("currency").rlike(fixed.CURRENCY_CODE),
            lambda: [F.col("order_id"), F.col("currency")],
        ),
        "status": RowCheck(
            "orders",
            lambda: ~text.status_spaced(F.col("status")).isin(*fixed.KNOWN_STATUSES),
            lambda: [F.col("order_id"), F.col("status")],
        ),
        "financial": RowCheck("orders", _mispriced, _mispriced_payload),
        "missing": FrameCheck(missing_orders),
        "no_items": FrameCheck(_without("items", "orders_with_zero_line_items")),
        "no_contact": FrameCheck(_without("contact", "orders_missing_primary_contact")),
        "multi_contact": FrameCheck(_multi_contact),
        "rollup": TotalCheck("orders", _rollup),
        "web_mix": FrameCheck(
            lambda t: t["orders"].groupBy("web_order").agg(F.count("*").alias("n"), _amount())
        ),
        "status_counts": FrameCheck(
            lambda t: t["orders"]
            .groupBy(text.status_spaced(F.col("status")).alias("status_norm"))
            .agg(F.count("*").alias("n"), _amount())
        ),
    },
    sides={
        # n0: rows of orders, n1: of the batch, n2: of line items, n3: of contacts
        "order": {
            "orders": Side(_order_id, one("n0")),
            "raw": Side(lambda: [F.col("id").alias("order_id")], one("n1")),
            "items": Side(_order_id, one("n2")),
            "contact": Side(_order_id, one("n3")),
        },
        "web": {"orders": Side(lambda: [F.col("web_order")], one("n0"), amount=_known_total)},
        "status": {"orders": Side(_status_norm, one("n0"), amount=_known_total)},
    },
    fused={
        "duplicates": KeyRows("order", lambda: F.col("n0") > 1, _cnt),
        "missing": KeyRows("order", lambda: (F.col("n1") > 0) & lacks("n0")),
        "no_items": KeyTotals("order", lambda: [F.when(lacks("n2"), F.col("n0"))], lambda: [zero("n0", "orders_with_zero_line_items")]),
        "no_contact": KeyTotals("order", lambda: [F.when(lacks("n3"), F.col("n0"))], lambda: [zero("n0", "orders_missing_primary_contact")]),
        "multi_contact": KeyTotals("order", lambda: [(F.col("n3") > 1).cast("long")], lambda: [zero("n0", "orders_with_multiple_primary_contacts")]),
        "web_mix": KeyRows("web", lambda: F.lit(True), _n_and_amount),
        "status_counts": KeyRows("status", lambda: F.lit(True), _n_and_amount),
    },
    few=frozenset({"web", "status"}),
)
