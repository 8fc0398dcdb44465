"""Normalised orders: one row per order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import fixed, money, text
from turnstile.operators.upsert import upsert
from turnstile.sources.schema import BOOL, LONG, MONEY, TEXT, WHEN, record

# Column of the table, field of the document.
RENAMED = {
    "order_id": "id",
    "conceirge_id": "conceirgeId",
    "created_date": "createdDate",
    "modified_date": "modifiedDate",
    "status": "status",
    "salesoffice_id": "salesOfficeId",
    "salesoffice_name": "salesOfficeName",
    "sales_person_firstname": "salesPersonFirstName",
    "sales_person_lastname": "salesPersonLastName",
    "sales_person_id": "salesPersonId",
    "web_order": "isWebOrder",
}
AMOUNTS = {
    "total": "total",
    "tax_total": "taxTotal",
    "subtotal": "subTotal",
    "discount_total": "discountTotal",
    "gratuity_total": "gratuityTotal",
}
DERIVED = {
    "currency": "currencyName",
    "question": "questions",
    "contact_group_id": "contactGroupId",
    "contact_group_name": "contactGroupName",
}
SCHEMA: T.StructType = record(
    order_id=LONG,
    conceirge_id=LONG,
    created_date=WHEN,
    modified_date=WHEN,
    status=TEXT,
    salesoffice_id=LONG,
    salesoffice_name=TEXT,
    sales_person_firstname=TEXT,
    sales_person_lastname=TEXT,
    sales_person_id=LONG,
    web_order=BOOL,
    total=MONEY,
    tax_total=MONEY,
    subtotal=MONEY,
    discount_total=MONEY,
    gratuity_total=MONEY,
    currency=TEXT,
    question=TEXT,
    contact_group_id=LONG,
    contact_group_name=TEXT,
)
KEYS = ("order_id",)
# A change in any of these refreshes exactly these: dates and offices keep their first value.
TRACKED = (
    "currency",
    "total",
    "tax_total",
    "subtotal",
    "discount_total",
    "gratuity_total",
    "status",
)


def fields_for(columns: Iterable[str]) -> tuple[str, ...]:
    """Document fields that the given columns of the table come from."""
    source = {**RENAMED, **AMOUNTS, **DERIVED}
    return tuple(source[c] for c in columns)


def orders_transform(raw: DataFrame, only: Iterable[str] = SCHEMA.names) -> DataFrame:
    """Rename, type and normalise; ``only`` limits the columns for narrow documents."""
    derive = {
        "currency": text.normalize_currency,
        "question": lambda c: F.coalesce(c, F.lit("null")),
        **{name: money.stored for name in AMOUNTS},
    }
    out = []
    for name, field in zip(only, fields_for(only)):
        make = derive.get(name)
        out.append((make(F.col(field)) if make else F.col(field)).alias(name))
    return raw.select(*out)


def orders_upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, KEYS, TRACKED)


def bad_currency(orders: DataFrame) -> DataFrame:
    return orders.filter(
        F.col("currency").isNotNull() & ~F.col("currency").rlike(fixed.CURRENCY_CODE)
    )
