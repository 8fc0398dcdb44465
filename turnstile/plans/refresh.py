"""The daily run: history, four loads, four validations; the first failure stops it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from turnstile.operators import contact as C
from turnstile.operators import event as EV
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.quality import contact as QC
from turnstile.operators.quality import event as QE
from turnstile.operators.quality import line_items as QL
from turnstile.operators.quality import orders as QO
from turnstile.operators.quality.report import gate
from turnstile.operators.upsert import enforce, insert_new
from turnstile.operators.views.rules import flat_visits
from turnstile.session import prepare, staged
from turnstile.sources import schema as S
from turnstile.sources.history import VERSION, history_fresh
from turnstile.sources.landing import raw_table
from turnstile.sources.tables import StoredTable, audit_append, audit_log, by_month, by_number
from turnstile.sources.visits import RANKED, VisitTable


# Orders per bucket of the tables keyed by order.
ORDERS_PER_BUCKET = 1_000_000


def visit_table(versions: StoredTable) -> VisitTable:
    return VisitTable(versions, lambda docs: flat_visits(docs, keep=RANKED))


@dataclass
class Warehouse:
    """Where the tables of one installation live."""

    spark: SparkSession
    root: str
    orders_per_bucket: int = ORDERS_PER_BUCKET
    after_load: dict[str, Callable[[], None]] = field(default_factory=dict)

    def __post_init__(self):
        prepare(self.spark)

        def at(name, schema, bucket, appends=False):
            return StoredTable(self.spark, self.root, name, schema, bucket, appends)

        by_order = by_number("order_id", self.orders_per_bucket)
        self.orders = at("orders", O.SCHEMA, by_order)
        self.items = at("line_items", LI.SCHEMA, by_order, appends=True)
        self.contact = at("primary_contact", C.SCHEMA, by_order)
        self.event = at("event", EV.SCHEMA, by_month("event_date"))
        by_id = by_number("id", self.orders_per_bucket)
        self.versions = at("raw_data_history", S.HISTORY, by_id, appends=True)
        self.visits = visit_table(self.versions)
        self.audit_path = f"{self.root.rstrip('/')}/audit_log"

    def history(self, fields=None) -> DataFrame:
        """Stored versions, narrowed to the wanted fields and what tells the newest version."""
        wanted = {*fields, *VERSION, "ingestion_timestamp"} if fields else None
        return self.versions.read(S.narrow(S.HISTORY, wanted) if wanted else None)


def refresh(
    warehouse: Warehouse, landing: str, now: dt.datetime | None = None, strict: bool = False
) -> dict[str, int]:
    """Load one landed batch; the row counts of the four tables afterwards.

    Each load touches only the buckets its batch falls in, and so do the assertions
    after it. What was written before a failing assertion stays, and a validation
    report is kept before it is judged, so that failures can be looked at.
    """
    w, now = warehouse, now or dt.datetime.now(dt.timezone.utc)

    def batch(*fields):
        return raw_table(w.spark, landing, fields or None)

    touched = w.versions.buckets(batch("id"))
    seen = w.versions.read(S.narrow(S.HISTORY, VERSION), touched)
    w.versions.write(history_fresh(batch(), seen, now))
    w.visits.feed()

    def merge(table, source, fold):
        source = staged(source)
        touched = table.buckets(source)
        table.write(fold(table.read(buckets=touched), source))
        return table.read(buckets=touched)

    source = O.orders_transform(batch(*O.fields_for(O.SCHEMA.names)))
    changed = merge(w.orders, source, O.orders_upsert)
    enforce(O.bad_currency(changed), "orders hold a currency that is not a three-letter code")

    source = LI.line_items_transform(batch(*LI.fields_for(LI.SCHEMA.names)))
    changed = merge(w.items, source, lambda held, new: insert_new(held, new, LI.KEYS))
    enforce(LI.repeated(changed), "line items repeat at (order_id, line_item_id, rate_type)")

    source = C.contact_transform(batch(*S.CONTACT_FIELDS))
    changed = merge(w.contact, source, C.contact_upsert)
    enforce(C.repeated(changed), "primary contacts repeat for an order")

    source = EV.event_transform(batch(*S.EVENT_FIELDS), strict)
    changed = merge(w.event, source, EV.event_upsert)
    enforce(EV.repeated(changed), "events repeat at (schedule_id, event_date, event_start)")

    for again in w.after_load.values():
        again()

    named = {"orders": w.orders, "items": w.items, "contact": w.contact, "event": w.event}
    tables = {name: table.read() for name, table in named.items()}
    needs = (
        (QO.SUITE, ("id",)),
        (QL.SUITE, ("id", "lineItems.id", "lineItems.rateTypes.rateType")),
        (QC.SUITE, ("id",)),
        (QE.SUITE, S.SCHEDULE_FIELDS),
    )
    for suite, fields in needs:
        report = suite.report({**tables, "raw": batch(*fields)})
        audit_append(report, suite.table, w.audit_path, now)
        # Judge what was stored instead of running the checks a second time.
        gate(audit_log(w.spark, w.audit_path, suite.table, now), suite.table, strict)
    return {name: df.count() for name, df in tables.items()}
