"""Normalised primary contact: one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import text
from turnstile.operators.upsert import duplicates, upsert
from turnstile.sources.schema import BOOL, LONG, TEXT, record

SCHEMA: T.StructType = record(
    contact_surrogate_key=TEXT,
    primary_contact_id=LONG,
    first_name=TEXT,
    last_name=TEXT,
    email=TEXT,
    phone=TEXT,
    address_line1=TEXT,
    address_line2=TEXT,
    city=TEXT,
    province=TEXT,
    postal_code=TEXT,
    country=TEXT,
    order_id=LONG,
    is_unknown_contact=BOOL,
)
KEYS = ("order_id",)
TRACKED = tuple(c for c in SCHEMA.names if c not in ("contact_surrogate_key", "order_id"))
ADDRESS = {
    "address_line1": "addressLine1",
    "address_line2": "addressLine2",
    "city": "city",
    "province": "province",
    "postal_code": "postalCode",
    "country": "country",
}


def contact_transform(raw: DataFrame) -> DataFrame:
    who = {f: F.col(f"primaryContact.{f}") for f in ("firstName", "lastName", "email", "phone")}
    return raw.select(
        text.stable_key(F.col("id")).alias("contact_surrogate_key"),
        F.col("primaryContact.id").alias("primary_contact_id"),
        text.trim_ws(who["firstName"]).alias("first_name"),
        text.trim_ws(who["lastName"]).alias("last_name"),
        text.clean_email(who["email"]).alias("email"),
        text.clean_phone(who["phone"]).alias("phone"),
        *[
            text.trim_ws(F.col(f"primaryContact.billingAddress.{field}")).alias(name)
            for name, field in ADDRESS.items()
        ],
        F.col("id").alias("order_id"),
        text.unknown_contact(
            who["email"], who["firstName"], who["lastName"], who["phone"]
        ).alias("is_unknown_contact"),
    )


def contact_upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, KEYS, TRACKED)


def repeated(contact: DataFrame) -> DataFrame:
    return duplicates(contact, KEYS)


def contact_masked(contact: DataFrame) -> DataFrame:
    """The contact table with nothing left that identifies a person."""
    hidden = F.lit(None).cast("string")
    masked = {
        "first_name": hidden,
        "last_name": hidden,
        "email": text.mask_email(F.col("email")),
        "phone": text.mask_phone(F.col("phone")),
        "address_line1": hidden,
        "address_line2": hidden,
    }
    return contact.select(*[masked.get(c, F.col(c)).alias(c) for c in SCHEMA.names])
