"""Checks on line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import fixed, money, text
from turnstile.operators.line_items import KEYS
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
    distinct_keys,
    one,
    zero,
)
from turnstile.operators.unnest import unnest_line_rates
from turnstile.operators.upsert import duplicates


def li_key() -> Column:
    """Business key as text with a marker for each missing part."""
    return F.concat(
        F.lit("O:"),
        text.marked(F.col("order_id"), "NULL"),
        F.lit("|LI:"),
        text.marked(F.col("line_item_id"), "NULL"),
        F.lit("|RT:"),
        text.marked(F.col("rate_type"), "NULL"),
    )


def raw_keys(raw: DataFrame) -> DataFrame:
    """Business key of every rate entry in the batch, complete keys only."""
    return _complete(rate_lines(raw))


def rate_lines(raw: DataFrame) -> DataFrame:
    """Order, line and rate type of every rate entry in the batch."""
    return unnest_line_rates(raw, "id", outer=False).select(
        F.col("id").alias("order_id"),
        F.col("li.id").alias("line_item_id"),
        F.col("ra.rateType").alias("rate_type"),
    )


def _is_complete() -> Column:
    return F.col("line_item_id").isNotNull() & F.col("rate_type").isNotNull()


def _complete(rows: DataFrame) -> DataFrame:
    return rows.filter(_is_complete()).select(*KEYS)


def _line_key() -> list[Column]:
    return [F.col(c) for c in KEYS]


def _keys_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct keys of one side that the other lacks; an absent order id equals another."""
    a, b = left.distinct().alias("a"), right.distinct().alias("b")
    same = (
        F.col("a.order_id").eqNullSafe(F.col("b.order_id"))
        & (F.col("a.line_item_id") == F.col("b.line_item_id"))
        & (F.col("a.rate_type") == F.col("b.rate_type"))
    )
    return a.join(b, same, "left_anti").select(*KEYS).withColumn("li_key", li_key())


def missing_keys(t: Tables) -> DataFrame:
    return _keys_only_in(raw_keys(t["raw"]), _complete(t["items"]))


def extra_keys(t: Tables) -> DataFrame:
    """Stored keys the batch does not hold; computed but not part of the report."""
    return _keys_only_in(_complete(t["items"]), raw_keys(t["raw"]))


def table_duplicates(t: Tables, strict: bool = False) -> DataFrame:
    """Keys stored more than once.

    The suite counts over a set that is distinct already, so it never reports any;
    ``strict`` counts the stored rows.
    """
    rows = t["items"].select(*KEYS)
    return _repeated(rows if strict else rows.distinct())


def raw_fanout(t: Tables, strict: bool = False) -> DataFrame:
    """Keys delivered more than once, with the same blind spot and the same remedy."""
    rows = raw_keys(t["raw"])
    return _repeated(rows if strict else rows.distinct())


def _repeated(rows: DataFrame) -> DataFrame:
    return duplicates(rows, KEYS).select(li_key().alias("li_key"), "cnt")


NUMBERS = ("line_item_price", "line_item_quantity", "line_item_tax_total", "line_item_subtotal")


def _negative() -> Column:
    hit = F.col(NUMBERS[0]) < 0
    for c in NUMBERS[1:]:
        hit = hit | (F.col(c) < 0)
    return hit


PRICED = ("surrogate_key", *KEYS, *NUMBERS, "coupon_amount", "price_override_amount")


def _negative_payload() -> list[Column]:
    return [F.col(c) for c in PRICED]


def _price_gap() -> Column:
    """Distance of the subtotal from (price + override) * quantity - coupon."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c), money.stored(F.lit(0)))

    quantity = F.coalesce("line_item_quantity", F.lit(0)).cast("decimal(19,0)")
    unit = known("line_item_price") + known("price_override_amount")
    return F.abs(known("line_item_subtotal") - (unit * quantity - known("coupon_amount")))


def _wide_gap() -> Column:
    return _price_gap() > F.lit(fixed.LINE_TOLERANCE).cast("decimal(4,2)")


def _math(t: Tables) -> DataFrame:
    off = t["items"].filter(_wide_gap()).select("order_id", _price_gap().alias("gap"))
    return off.agg(
        F.count("*").alias("line_items_affected"),
        F.count_distinct("order_id").alias("orders_affected"),
        F.max("gap").alias("max_abs_delta"),
    )


def _serials_repeat() -> Column:
    """Splitting on the comma with the space around it trims every token on the way."""
    tokens = F.split(text.trim_ws(F.col("serials")), rf"{fixed.SPACES}*,{fixed.SPACES}*")
    return F.size(tokens) != F.size(F.array_distinct(tokens))


def _keys(t: Tables) -> DataFrame:
    return t["items"].agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("surrogate_key").alias("distinct_surrogate_keys"),
    )


def _null_counts() -> list[Column]:
    checked = {
        "order_id": "order_id",
        "line_item_id": "line_item_id",
        "rate_type": "rate_type",
        "line_item_price": "price",
        "line_item_quantity": "quantity",
        "line_item_subtotal": "subtotal",
        "line_item_tax_total": "tax_total",
    }
    return [F.count_if(F.col(c).isNull()).alias(f"null_{n}") for c, n in checked.items()]


SUITE = Suite(
    "line_items",
    names.LINE_ITEMS,
    {
        "duplicates": FrameCheck(table_duplicates),
        "missing": FrameCheck(missing_keys),
        "keys": FrameCheck(_keys),
        "nulls": TotalCheck("items", _null_counts),
        "negatives": RowCheck("items", _negative, _negative_payload),
        "math": FrameCheck(_math),
        "serials": RowCheck(
            "items",
            _serials_repeat,
            lambda: [F.col(c) for c in ("surrogate_key", *KEYS, "serials")],
        ),
        "fanout": FrameCheck(raw_fanout),
    },
    sides={
        "line": {
            "items": Side(_line_key, one("n0"), _is_complete),
            "raw": Side(_line_key, one("n1"), _is_complete),
        },
        "surrogate": {"items": Side(lambda: [F.col("surrogate_key")], one("n0"))},
        "gap": {
            "items": Side(lambda: [F.col("order_id")], one("n0"), _wide_gap, _price_gap),
        },
    },
    fused={
        "missing": KeyRows("line", lambda: (F.col("n1") > 0) & (F.col("n0") == 0), lambda: [li_key().alias("li_key")]),
        "keys": KeyTotals("surrogate", *distinct_keys("distinct_surrogate_keys")),
        "math": KeyTotals(
            "gap",
            lambda: [F.col("n0"), F.col("whole").cast("long")],
            lambda: [zero("n0", "line_items_affected"), zero("n1", "orders_affected"), F.col("most").alias("max_abs_delta")],
            lambda: F.col("top"),
        ),
    },
    silent=frozenset({"duplicates", "fanout"}),
    lines={"raw": rate_lines},
)
