"""Normalised line items: one row per order, line item and rate type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import money, text
from turnstile.operators.unnest import unnest_line_rates
from turnstile.operators.upsert import duplicates, insert_new
from turnstile.sources.schema import LONG, MONEY, TEXT, record

SCHEMA: T.StructType = record(
    surrogate_key=TEXT,
    line_item_id=LONG,
    line_item_type=TEXT,
    line_item_type_id=LONG,
    line_item_name=TEXT,
    product_id=TEXT,
    line_item_price=MONEY,
    line_item_tax_total=MONEY,
    line_item_subtotal=MONEY,
    serials=TEXT,
    line_item_quantity=LONG,
    rate_type=TEXT,
    coupon_amount=MONEY,
    price_override_amount=MONEY,
    order_id=LONG,
)
KEYS = ("order_id", "line_item_id", "rate_type")


# Column of the table, place in the unnested row.
PLACES = {
    "order_id": "id",
    "line_item_id": "li.id",
    "line_item_type": "li.type",
    "line_item_type_id": "li.typeId",
    "line_item_name": "li.name",
    "product_id": "li.productId",
    "rate_type": "ra.rateType",
    "line_item_price": "ra.price",
    "line_item_tax_total": "ra.taxTotal",
    "line_item_subtotal": "ra.subTotal",
    "serials": "ra.serials",
    "line_item_quantity": "ra.quantity",
    "coupon_amount": "ra.couponAmount",
    "price_override_amount": "ra.priceOverrideAmount",
}
LEVELS = {"": "", "li": "lineItems.", "ra": "lineItems.rateTypes."}
# What sale measures read.
SALE = ("order_id", "rate_type", "line_item_quantity", "line_item_subtotal")


def fields_for(columns: Iterable[str]) -> tuple[str, ...]:
    """Document fields that the given columns, and the key filter, come from."""
    found = []
    for column in dict.fromkeys((*KEYS, *(c for c in columns if c != "surrogate_key"))):
        level, field = PLACES[column].rpartition(".")[::2]
        found.append(LEVELS[level] + field)
    return tuple(found)


def _column(name: str) -> Column:
    if name == "surrogate_key":
        parts = [F.col(PLACES[k]) for k in KEYS] + [F.col("line_pos"), F.col("rate_pos")]
        return text.stable_key(*parts)
    value = F.col(PLACES[name])
    if name == "serials":
        return F.array_join(value, ",")
    kind = SCHEMA[name].dataType
    return money.stored(value) if kind == MONEY else value.cast(kind)


def line_items_transform(raw: DataFrame, only: Iterable[str] = SCHEMA.names) -> DataFrame:
    """Rows with a line id and a rate type; ``only`` limits the columns for narrow documents.

    Both filters reject the rows an outer unnest would add, so the inner form is used.
    The surrogate key adds the element's place in the document to the business key:
    repeatable on a task retry, and distinct for repeated elements of one document.
    """
    rows = unnest_line_rates(raw, "id", outer=False)
    rows = rows.filter("li.id is not null and ra.rateType is not null")
    return rows.select(*[_column(c).alias(c) for c in only])


def line_items_insert(target: DataFrame, source: DataFrame) -> DataFrame:
    """Insert-only: a stored row is never refreshed."""
    return target.unionByName(insert_new(target, source, KEYS))


def repeated(items: DataFrame) -> DataFrame:
    return duplicates(items, KEYS)
