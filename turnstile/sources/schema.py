"""Declared schema of an order document, and narrowed versions of it.

Schemas are never inferred: inference would change types between batches. Spark
prunes nested Parquet columns through one exploded field only, so a reader that
needs several nested fields passes a narrowed schema and the scan reads just
those leaves.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from turnstile.functions import money

LONG, TEXT, BOOL, WHEN, DAY = (
    T.LongType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampType(),
    T.DateType(),
)
MONEY = T.DecimalType(money.DIGITS, money.SCALE)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SCHEDULE = record(id=LONG, date=TEXT, startTime=TEXT, endTime=TEXT)
RATE = record(
    rateType=TEXT,
    price=MONEY,
    taxTotal=MONEY,
    subTotal=MONEY,
    quantity=LONG,
    serials=T.ArrayType(TEXT),
    couponAmount=MONEY,
    priceOverrideAmount=MONEY,
)
LINE = record(
    id=LONG,
    type=TEXT,
    typeId=LONG,
    name=TEXT,
    productId=LONG,
    salesOfficeName=TEXT,
    event=record(id=LONG, type=TEXT, name=TEXT, schedule=SCHEDULE),
    rateTypes=T.ArrayType(RATE),
)
ADDRESS = record(
    addressLine1=TEXT, addressLine2=TEXT, city=TEXT, province=TEXT, postalCode=TEXT, country=TEXT
)
CONTACT = record(
    id=LONG, firstName=TEXT, lastName=TEXT, email=TEXT, phone=TEXT, billingAddress=ADDRESS
)
RAW = record(
    id=LONG,
    createdDate=WHEN,
    modifiedDate=WHEN,
    status=TEXT,
    conceirgeId=LONG,
    salesOfficeId=LONG,
    salesOfficeName=TEXT,
    salesPersonId=LONG,
    salesPersonFirstName=TEXT,
    salesPersonLastName=TEXT,
    isWebOrder=BOOL,
    currencyName=TEXT,
    total=MONEY,
    subTotal=MONEY,
    taxTotal=MONEY,
    discountTotal=MONEY,
    gratuityTotal=MONEY,
    variableFeeTotal=MONEY,
    orderUrl=TEXT,
    contactGroupId=LONG,
    contactGroupName=TEXT,
    questions=TEXT,  # whole, as JSON text: its keys are not known beforehand
    primaryContact=CONTACT,
    lineItems=T.ArrayType(LINE),
)
INGESTION = (T.StructField("ingestion_timestamp", WHEN), T.StructField("ingestion_date", DAY))
HISTORY = T.StructType(RAW.fields + list(INGESTION))


def narrow(schema: T.DataType, paths: Iterable[str]) -> T.DataType:
    """The part of a schema that holds the dotted paths; arrays count as their element."""
    paths = set(paths)
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(narrow(schema.elementType, paths), schema.containsNull)
    kept = []
    for field in schema.fields:
        if field.name in paths:
            kept.append(field)
            continue
        inner = {p.split(".", 1)[1] for p in paths if p.startswith(field.name + ".")}
        if inner:
            kept.append(T.StructField(field.name, narrow(field.dataType, inner), field.nullable))
    missing = {p.split(".", 1)[0] for p in paths} - {f.name for f in kept}
    if missing:
        raise ValueError(f"not in the schema: {sorted(missing)}")
    return T.StructType(kept)


# What each consumer reads of a document.
CONTACT_FIELDS = ("id", "primaryContact")
_RATE = "lineItems.rateTypes."
EVENT_FIELDS = ("id", "lineItems.event")
SCHEDULE_FIELDS = ("id", "lineItems.event.id", "lineItems.event.schedule")
VISIT_FIELDS = (
    "id",
    "modifiedDate",
    "status",
    "lineItems.type",
    "lineItems.salesOfficeName",
    "lineItems.event.schedule.date",
    _RATE + "rateType",
    _RATE + "quantity",
    _RATE + "subTotal",
)
MEMBERSHIP_FIELDS = (
    "id",
    "modifiedDate",
    "status",
    "createdDate",
    "lineItems.type",
    "lineItems.name",
    _RATE + "quantity",
    _RATE + "subTotal",
)
