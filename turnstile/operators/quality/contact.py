"""Checks on primary contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import fixed, text
from turnstile.operators.quality import names
from turnstile.operators.quality.orders import raw_ids
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
    lacks,
    one,
    zero,
)
from turnstile.operators.upsert import duplicates, lacking


def _derived_flag() -> Column:
    return text.unknown_contact(*[F.col(c) for c in ("email", "first_name", "last_name", "phone")])


def _stored_flag() -> Column:
    return F.col("is_unknown_contact").cast("string").try_cast("boolean")


def _null_counts() -> list[Column]:
    return [
        F.count("*").alias("total_rows"),
        F.count_if(F.col("contact_surrogate_key").isNull()).alias("null_contact_surrogate_key"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(text.blank_email(F.col("email"))).alias("empty_email"),
        F.count_if(text.blank(F.col("first_name"))).alias("empty_first_name"),
        F.count_if(text.blank(F.col("last_name"))).alias("empty_last_name"),
        F.count_if(text.blank_phone(F.col("phone"))).alias("empty_phone"),
    ]


def _unknown() -> list[Column]:
    unknown, every = F.count_if(_derived_flag()), F.count("*")
    return [
        every.alias("total_rows"),
        unknown.alias("unknown_rows"),
        F.try_divide(unknown.cast("double"), every.cast("double")).alias("unknown_rate"),
    ]


def _bad_email() -> Column:
    return F.col("email").isNotNull() & ~F.lower(text.trim_ws(F.col("email"))).rlike(fixed.EMAIL_FORM)


def _email(t: Tables) -> DataFrame:
    """Rows, orders and share with a malformed address, in one pass."""
    rows, every = F.count_if("bad"), F.count("*")
    return t["contact"].select("order_id", _bad_email().alias("bad")).agg(
        rows.alias("bad_email_rows"),
        F.count_distinct(F.when(F.col("bad"), F.col("order_id"))).alias("affected_orders"),
        F.try_divide(rows.cast("double"), every.cast("double")).alias("bad_email_rate"),
    )


def _unclean_email() -> Column:
    email = F.col("email")
    return (email != text.trim_ws(email)) | (email != F.lower(email))


def _keys(t: Tables) -> DataFrame:
    return t["contact"].agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("contact_surrogate_key").alias("distinct_surrogate_keys"),
    )


def _missing(t: Tables) -> DataFrame:
    return lacking(raw_ids(t["raw"]), t["contact"], ["order_id"])


def _repeats(rows: DataFrame, key: str, name: str) -> DataFrame:
    """How many values repeat, how many rows they cover, and the largest group."""
    return duplicates(rows, [key]).agg(
        F.count("*").alias(name),
        F.sum("cnt").alias("total_rows_involved"),
        F.max("cnt").alias("max_dup_count"),
    )


def _dup_ids(t: Tables) -> DataFrame:
    rows = t["contact"].filter("primary_contact_id is not null")
    return _repeats(rows, "primary_contact_id", "distinct_primary_contact_ids_with_dups")


def _dup_emails(t: Tables) -> DataFrame:
    rows = t["contact"].filter(~text.blank_email(F.col("email")))
    rows = rows.select(F.lower(text.trim_ws(F.col("email"))).alias("email_lc"))
    return _repeats(rows, "email_lc", "distinct_emails_with_dups")


def _email_lc() -> list[Column]:
    return [F.lower(text.trim_ws(F.col("email"))).alias("email_lc")]


def _repeated(name: str):
    """Parts, payload and greatest of what _repeats tells."""
    twice = lambda: F.col("n0") > 1
    return (
        lambda: [twice().cast("long"), F.when(twice(), F.col("n0"))],
        lambda: [zero("n0", name), F.col("n1").alias("total_rows_involved"), F.col("most").cast("long").alias("max_dup_count")],
        lambda: F.when(twice(), F.col("n0")),
    )


SUITE = Suite(
    "primary_contact",
    names.CONTACT,
    {
        "nulls": TotalCheck("contact", _null_counts),
        "duplicates": FrameCheck(
            lambda t: duplicates(t["contact"].filter("order_id is not null"), ["order_id"])
        ),
        "keys": FrameCheck(_keys),
        "unknown": TotalCheck("contact", _unknown),
        "flag": RowCheck(
            "contact",
            lambda: _stored_flag().isNotNull() & ~_stored_flag().eqNullSafe(_derived_flag()),
            lambda: [
                F.col("order_id"),
                F.col("contact_surrogate_key"),
                _derived_flag().alias("is_unknown_derived"),
                _stored_flag().alias("is_unknown_stored"),
            ],
        ),
        "email": FrameCheck(_email),
        "email_case": RowCheck(
            "contact",
            _unclean_email,
            lambda: [F.col(c) for c in ("primary_contact_id", "order_id", "email")],
        ),
        "missing": FrameCheck(_missing),
        "dup_ids": FrameCheck(_dup_ids),
        "dup_emails": FrameCheck(_dup_emails),
    },
    sides={
        # n0: rows of contacts, n1: of the batch, n2: contacts with a malformed address
        "order": {
            "contact": Side(
                lambda: [F.col("order_id")],
                lambda: {"n0": F.lit(1), "n2": F.when(_bad_email(), 1).otherwise(0)},
            ),
            "raw": Side(lambda: [F.col("id").alias("order_id")], one("n1")),
        },
        "surrogate": {"contact": Side(lambda: [F.col("contact_surrogate_key")], one("n0"))},
        "id": {
            "contact": Side(lambda: [F.col("primary_contact_id")], one("n0"), lambda: F.col("primary_contact_id").isNotNull()),
        },
        "email": {
            "contact": Side(_email_lc, one("n0"), lambda: ~text.blank_email(F.col("email"))),
        },
    },
    fused={
        "duplicates": KeyRows("order", lambda: F.col("whole") & (F.col("n0") > 1), lambda: [F.col("n0").alias("cnt")]),
        "keys": KeyTotals("surrogate", *distinct_keys("distinct_surrogate_keys")),
        "email": KeyTotals(
            "order",
            lambda: [F.col("n2"), (F.col("whole") & (F.col("n2") > 0)).cast("long"), F.col("n0")],
            lambda: [
                zero("n0", "bad_email_rows"),
                zero("n1", "affected_orders"),
                F.try_divide(F.col("n0").cast("double"), F.col("n2").cast("double")).alias("bad_email_rate"),
            ],
        ),
        "missing": KeyRows("order", lambda: (F.col("n1") > 0) & lacks("n0")),
        "dup_ids": KeyTotals("id", *_repeated("distinct_primary_contact_ids_with_dups")),
        "dup_emails": KeyTotals("email", *_repeated("distinct_emails_with_dups")),
    },
)
