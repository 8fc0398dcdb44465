"""Named queries over the star tables: name -> f(spark, sf_dir) -> DataFrame.

Each builds the documents it needs from the flat tables, runs the operator over all
of them and returns a lazy DataFrame. Reporting parameters are fixed here.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterator
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import clock
from turnstile.operators import contact as C
from turnstile.operators import event as EV
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators import questions as Q
from turnstile.operators import snapshot
from turnstile.operators.quality import contact as QC
from turnstile.operators.quality import event as QE
from turnstile.operators.quality import line_items as QL
from turnstile.operators.quality import monitor
from turnstile.operators.quality import orders as QO
from turnstile.operators.quality.report import Suite
from turnstile.operators.screen import query_log_screen
from turnstile.operators.unnest import unnest_events, unnest_lines, unnest_rates
from turnstile.operators.upsert import verdict
from turnstile.operators.views import attendance, governed, membership, revenue, transactions
from turnstile.plans.answers import LOG
from turnstile.session import remove, shuffles_go, staged, work_folder
from turnstile.sources import landing, star
from turnstile.sources import schema as S
from turnstile.sources.history import history_latest
from turnstile.sources.passes import Part, in_passes, kept, passes
from turnstile.plans.refresh import ORDERS_PER_BUCKET, visit_table
from turnstile.sources.tables import StoredTable, audit_log, by_number
from turnstile.sources.tables import audit_append as audit_append_to
from turnstile.sources.visits import VisitTable

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1997
AS_OF = dt.date(1997, 7, 1)
# Last local day of the earlier range load that merge and completeness queries start from.
FIRST_DAY, CUT = dt.date(1990, 1, 1), dt.date(1999, 6, 30)

SALE_HEAD = ("order_id", "created_date", "status", "salesoffice_name", "total")


def edge(df: DataFrame) -> DataFrame:
    """Plain types for comparison: doubles for money, instants without a zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c, 2).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def orders_of(spark: SparkSession, sf: str, *columns: str, second: bool = False) -> DataFrame:
    """Normalised orders with the named columns (all by default)."""
    only = columns or tuple(O.SCHEMA.names)
    return O.orders_transform(star.documents(spark, sf, O.fields_for(only), second), only)


def items_of(spark: SparkSession, sf: str, *columns: str, part: Part | None = None) -> DataFrame:
    """Normalised line items with the named columns (all by default)."""
    only = columns or tuple(LI.SCHEMA.names)
    return LI.line_items_transform(
        star.documents(spark, sf, LI.fields_for(only), keep_empty=False, part=part), only
    )


def sales_of(spark: SparkSession, sf: str) -> DataFrame:
    return items_of(spark, sf, *LI.SALE)


def typed_sales_of(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with line type and product."""
    return items_of(spark, sf, *LI.SALE, "line_item_type", "product_id")


def _with_sales(measure) -> Query:
    return lambda spark, sf: measure(orders_of(spark, sf, *SALE_HEAD), sales_of(spark, sf), YEAR)


def _with_typed_sales(measure) -> Query:
    return lambda spark, sf: measure(
        orders_of(spark, sf, *TICKET_HEAD), typed_sales_of(spark, sf), YEAR
    )


def _with_orders(measure) -> Query:
    return lambda spark, sf: measure(orders_of(spark, sf, *SALE_HEAD), YEAR)


def _with_history(measure, fields, *args) -> Query:
    return lambda spark, sf: measure(star.history(spark, sf, fields), *args)


def view_queries() -> dict[str, Query]:
    visit, member = S.VISIT_FIELDS, S.MEMBERSHIP_FIELDS
    return {
        "average_daily_revenue": _with_sales(revenue.average_daily_revenue),
        "median_daily_revenue": _with_sales(revenue.median_daily_revenue),
        "monthly_revenue_by_ticket_type": _with_sales(revenue.monthly_revenue_by_ticket_type),
        "revenue_by_sales_channel": _with_sales(revenue.revenue_by_sales_channel),
        "revenue_per_visitor": _with_history(revenue.revenue_per_visitor, visit, YEAR),
        "transactions_daily_average": _with_orders(transactions.transactions_daily_average),
        "transactions_daily_median": _with_orders(transactions.transactions_daily_median),
        "transactions_value_average": _with_orders(transactions.transactions_value_average),
        "transactions_value_median": _with_orders(transactions.transactions_value_median),
        "refund_void_rate": _with_orders(transactions.refund_void_rate),
        "monthly_headcount_by_ticket_type": _with_history(
            attendance.monthly_headcount_by_ticket_type, visit, YEAR
        ),
        "visitor_count_by_sales_channel": _with_history(
            attendance.visitor_count_by_sales_channel, visit, YEAR
        ),
        "yesterdays_tickets_sold": _with_history(attendance.yesterdays_tickets_sold, visit, AS_OF),
        "seven_day_headcount": _with_history(attendance.seven_day_headcount, visit, AS_OF),
        "thirty_day_headcount": _with_history(attendance.thirty_day_headcount, visit, AS_OF),
        "membership_summary": _with_history(membership.membership_summary, member, YEAR),
        "membership_tabular": _with_history(membership.membership_tabular, member, YEAR),
        "monthly_ticket_revenue": _with_typed_sales(revenue.monthly_ticket_revenue),
    }


_visit_tables: dict[tuple[str, str], VisitTable] = {}


def stored_visits(spark: SparkSession, sf: str) -> VisitTable:
    """The flat visits of both deliveries, each fed as a load of its own; made once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _visit_tables:
        fields = {*S.VISIT_FIELDS, "ingestion_timestamp", "ingestion_date"}
        hist = [star.history(spark, sf, S.VISIT_FIELDS, part) for part in passes(raw_ids(spark, sf))]
        schema = S.narrow(S.HISTORY, fields)
        root = f"{work_folder(spark)}/visits-{uuid.uuid4().hex}"
        versions = StoredTable(spark, root, "versions", schema, by_number("id", ORDERS_PER_BUCKET), appends=True)
        table = visit_table(versions)
        for run in (star.FIRST_RUN, star.SECOND_RUN):
            versions.write(*[rows.filter(F.col("ingestion_timestamp") == F.lit(run)) for rows in hist])
            table.feed()
        _visit_tables[key] = table
    return _visit_tables[key]


def _with_visits(measure, *args) -> Query:
    return lambda spark, sf: measure(stored_visits(spark, sf), *args)


VISIT_MEASURES = {
    "revenue_per_visitor": (revenue.revenue_per_visitor, YEAR),
    "monthly_headcount_by_ticket_type": (attendance.monthly_headcount_by_ticket_type, YEAR),
    "visitor_count_by_sales_channel": (attendance.visitor_count_by_sales_channel, YEAR),
    "yesterdays_tickets_sold": (attendance.yesterdays_tickets_sold, AS_OF),
    "seven_day_headcount": (attendance.seven_day_headcount, AS_OF),
    "thirty_day_headcount": (attendance.thirty_day_headcount, AS_OF),
}


def visit_queries() -> dict[str, Query]:
    """The visit measures over stored visits, of all versions and of the newest."""
    out = {}
    for name, (measure, when) in VISIT_MEASURES.items():
        out[f"stored_{name}"] = _with_visits(measure, when)
        out[f"latest_{name}"] = _with_visits(measure, when, True)
    return out


def loaded(raw: DataFrame) -> DataFrame:
    """The part of a delivery that an earlier range load brought in."""
    return landing.extract_window(raw, FIRST_DAY, CUT)


def orders_loaded(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    only = columns or tuple(O.SCHEMA.names)
    fields = set(O.fields_for(only)) | {"createdDate"}
    return O.orders_transform(loaded(star.documents(spark, sf, fields)), only)


def lines_loaded(spark: SparkSession, sf: str, fields, part: Part | None = None) -> DataFrame:
    """Line documents of orders in the earlier range load."""
    return loaded(star.documents(spark, sf, set(fields) | {"createdDate"}, keep_empty=False, part=part))


def contact_of(spark: SparkSession, sf: str, second: bool = False, part: Part | None = None) -> DataFrame:
    return C.contact_transform(star.documents(spark, sf, S.CONTACT_FIELDS, second, part=part))


def contact_loaded(spark: SparkSession, sf: str) -> DataFrame:
    fields = S.CONTACT_FIELDS + ("createdDate",)
    return C.contact_transform(loaded(star.documents(spark, sf, fields)))


def event_docs(spark: SparkSession, sf: str) -> DataFrame:
    return star.documents(spark, sf, S.EVENT_FIELDS, keep_empty=False)


def event_of(spark: SparkSession, sf: str, strict: bool = False) -> DataFrame:
    return EV.event_transform(event_docs(spark, sf), strict)


def event_unguarded(spark: SparkSession, sf: str) -> DataFrame:
    """The event table of a load that trusts every event id."""
    return EV.event_transform(event_docs(spark, sf), guard=False)


def _as_text(spark: SparkSession, sf: str, part: Part | None = None) -> DataFrame:
    """Documents as JSON lines, each with a key the schema does not list."""
    docs = star.documents(spark, sf, TEXT_FIELDS, part=part).withColumn("_unlisted", F.lit("x"))
    return docs.select(F.to_json(F.struct("*")).alias("line"))


def _scanned(docs: DataFrame) -> DataFrame:
    heads = ("id", "createdDate", "modifiedDate", "status", "total", "isWebOrder")
    return unnest_lines(docs, *heads).select(
        F.col("id").alias("order_id"),
        F.col("createdDate").alias("created"),
        F.col("modifiedDate").alias("modified"),
        "status",
        "total",
        F.col("isWebOrder").alias("web_order"),
        F.col("li.id").alias("line_item_id"),
        F.col("li.type").alias("line_item_type"),
        F.size("li.rateTypes").alias("rates"),
    )


def raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _scanned(landing.parse_documents(_as_text(spark, sf), "line", SCAN_SCHEMA))


# Lines of a text file: one that is packed goes to one task as a whole.
LINES_PER_FILE = 250_000


def _write_text(lines: DataFrame, folder: str) -> None:
    """Add lines to a folder of text files, packed: JSON repeats its keys in each line."""
    with shuffles_go(lines.sparkSession):
        lines.select("line").write.mode("append").option("maxRecordsPerFile", LINES_PER_FILE).text(folder, compression="gzip")


def backfill_load(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as JSON lines, landed in place of an earlier load of some of them, and read back.

    A delivery is gone once it is landed."""
    folder = f"{work_folder(spark)}/backfill-{uuid.uuid4().hex}"
    for part in passes(raw_ids(spark, sf)):
        _write_text(_as_text(spark, sf, part), f"{folder}/all")
    lines = landing.json_lines(spark, f"{folder}/all")
    _write_text(lines.filter(F.get_json_object("line", "$.id").cast("long") % 2 == 0), f"{folder}/first")
    for name in ("first", "all"):
        landed = landing.backfill_load(spark, f"{folder}/{name}", f"{folder}/landed")
        remove(spark, f"{folder}/{name}")
    return _scanned(landed)


def extract_window(spark: SparkSession, sf: str) -> DataFrame:
    docs = star.documents(spark, sf, VERSION_FIELDS + ("createdDate",))
    return landing.extract_window(docs, *landing.yesterday(AS_OF)).select(
        F.col("id").alias("order_id"),
        F.col("createdDate").alias("created"),
        F.col("modifiedDate").alias("modified"),
        "status",
        "total",
    )


def _versions(hist: DataFrame) -> DataFrame:
    return hist.select(
        F.col("id").alias("order_id"),
        F.col("modifiedDate").alias("modified"),
        "status",
        "total",
        "ingestion_date",
    )


def orders_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return O.orders_upsert(orders_loaded(spark, sf), orders_of(spark, sf, second=True))


def line_items_insert(spark: SparkSession, sf: str) -> DataFrame:
    """The merge key holds the order, so orders can be merged in passes."""

    def merged(part: Part) -> DataFrame:
        return LI.line_items_insert(items_loaded(spark, sf, part=part), items_of(spark, sf, part=part))

    return in_passes(raw_ids(spark, sf), merged)


def contact_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return C.contact_upsert(contact_loaded(spark, sf), contact_of(spark, sf, second=True))


def event_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides are read several times by the merge, so they are computed once, as in a load."""
    target = EV.event_transform(lines_loaded(spark, sf, S.EVENT_FIELDS), strict=True)
    return EV.event_upsert(staged(target), staged(event_of(spark, sf, strict=True)))


def _on_events(step) -> Query:
    return lambda spark, sf: step(event_docs(spark, sf))


def event_dedup_key(spark: SparkSession, sf: str) -> DataFrame:
    return EV.event_dedup_key(event_docs(spark, sf)).select(*EV.GRAIN, "event_id", "lines", "dedup_key")


RATE_FIELDS = LI.fields_for((*LI.SALE, "line_item_type", "line_item_name"))
VERSION_FIELDS = ("id", "modifiedDate", "status", "total")
SCAN_FIELDS = VERSION_FIELDS + ("createdDate", "isWebOrder", "lineItems.id", "lineItems.type")
SCAN_FIELDS += ("lineItems.rateTypes.rateType",)
SCAN_SCHEMA = S.narrow(S.RAW, SCAN_FIELDS)
# The text also holds fields that the declared schema drops.
TEXT_FIELDS = SCAN_FIELDS + ("orderUrl", "lineItems.name", "lineItems.rateTypes.quantity")


def load_queries() -> dict[str, Query]:
    return {
        "raw_scan": raw_scan,
        "backfill_load": backfill_load,
        "extract_window": extract_window,
        "history_merge": lambda s, d: _versions(star.history(s, d, VERSION_FIELDS)),
        "history_latest": lambda s, d: _versions(history_latest(star.history(s, d, VERSION_FIELDS))),
        "unnest_events": _on_events(unnest_events),
        "unnest_rates": lambda s, d: unnest_rates(star.documents(s, d, RATE_FIELDS)),
        "orders_transform": orders_of,
        "orders_upsert": orders_upsert,
        "line_items_transform": items_of,
        "line_items_insert": line_items_insert,
        "contact_transform": contact_of,
        "contact_upsert": contact_upsert,
        "event_transform": event_of,
        "event_transform_strict": lambda s, d: event_of(s, d, strict=True),
        "event_upsert": event_upsert,
        "event_dedup_key": event_dedup_key,
        "event_canonical_id": _on_events(EV.event_canonical_id),
        "event_dedup": _on_events(EV.event_dedup),
        "event_latest_end": _on_events(EV.event_latest_end),
        "assert_orders_currency": lambda s, d: verdict(O.bad_currency(orders_of(s, d, "currency"))),
        "assert_line_items_unique": lambda s, d: verdict(
            LI.repeated(items_of(s, d, *LI.KEYS))
        ),
        "assert_contact_unique": lambda s, d: verdict(C.repeated(contact_of(s, d))),
        "assert_event_unique": lambda s, d: verdict(EV.repeated(event_of(s, d))),
    }


KEY_FIELDS = ("id", "lineItems.id", "lineItems.rateTypes.rateType")


def raw_ids(spark: SparkSession, sf: str, part: Part | None = None) -> DataFrame:
    return star.documents(spark, sf, ("id",), part=part)


def raw_rate_keys(spark: SparkSession, sf: str, part: Part | None = None) -> DataFrame:
    return star.documents(spark, sf, KEY_FIELDS, keep_empty=False, part=part)


def raw_schedules(spark: SparkSession, sf: str, part: Part | None = None) -> DataFrame:
    return star.documents(spark, sf, S.SCHEDULE_FIELDS, keep_empty=False, part=part)


def order_ids_of_items(spark: SparkSession, sf: str) -> DataFrame:
    return items_of(spark, sf, "order_id")


def twice(df: DataFrame, again: DataFrame) -> DataFrame:
    """A table after a load that was repeated for the earlier range."""
    return df.unionByName(again)


def unclean_currency(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the currency text as delivered, before it is normalised."""
    docs = star.documents(spark, sf, ("id", "currencyName"))
    return docs.select(F.col("id").alias("order_id"), F.col("currencyName").alias("currency"))


def contacts_twice(spark: SparkSession, sf: str) -> DataFrame:
    return twice(contact_of(spark, sf), contact_loaded(spark, sf))


def contacts_masked(spark: SparkSession, sf: str) -> DataFrame:
    return C.contact_masked(contact_of(spark, sf))


def items_loaded(spark: SparkSession, sf: str, *columns: str, part: Part | None = None) -> DataFrame:
    only = columns or tuple(LI.SCHEMA.names)
    return LI.line_items_transform(lines_loaded(spark, sf, LI.fields_for(only), part), only)


def item_columns(*columns: str) -> Query:
    return lambda spark, sf: items_of(spark, sf, *columns)


def event_loaded(spark: SparkSession, sf: str) -> DataFrame:
    return EV.event_transform(lines_loaded(spark, sf, S.EVENT_FIELDS))


def _check(suite: Suite, name: str, **tables) -> Query:
    """One check over tables made for it."""
    return lambda s, d: suite.frame(name, {t: make(s, d) for t, make in tables.items()})


SUITES = (
    (QO.SUITE, raw_ids),
    (QL.SUITE, raw_rate_keys),
    (QC.SUITE, raw_ids),
    (QE.SUITE, raw_schedules),
)


def stored_tables(spark: SparkSession, sf: str, parts: list[Part]) -> dict[str, DataFrame]:
    """The four tables as a load leaves them: the suites read them from storage."""
    return {
        "event": kept(spark, [event_of(spark, sf)]),
        "orders": kept(spark, [orders_of(spark, sf)]),
        "items": kept(spark, (items_of(spark, sf, part=part) for part in parts)),
        "contact": kept(spark, (contact_of(spark, sf, part=part) for part in parts)),
    }


def _reports(spark: SparkSession, sf: str, names: Collection[str] | None = None) -> Iterator[tuple[str, DataFrame]]:
    """Table and report of each suite, or of the named ones; in as many slices as there are passes."""
    parts = passes(raw_ids(spark, sf))
    tables = stored_tables(spark, sf, parts)
    for suite, raw in SUITES:
        if names is not None and suite.table not in names:
            continue
        if len(parts) == 1:
            yield suite.table, suite.report({**tables, "raw": raw(spark, sf)})
        else:
            batch = kept(spark, (raw(spark, sf, part) for part in parts))
            yield suite.table, suite.report({**tables, "raw": batch}, len(parts), partial(kept, spark))


def plain_result(result: Column) -> Column:
    """A report line's JSON as sorted ``name=value`` text: six decimals, instants without a zone."""
    number, instant = r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$", r"^(\d{4}-\d\d-\d\d)T(\d\d:\d\d:\d\d)\.000Z$"

    def value(v: Column) -> Column:
        broken = v.rlike(number) & v.rlike(r"[.eE]")
        shown = F.when(broken, v.try_cast("decimal(38,6)").cast("string")).otherwise(F.regexp_replace(v, instant, "$1 $2"))
        return F.coalesce(shown, F.lit("null"))

    fields = F.array_sort(F.map_entries(F.from_json(result, "map<string,string>")))
    return F.array_join(F.transform(fields, lambda e: F.concat(e.key, F.lit("="), value(e.value))), "; ")


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the four reports with its result."""
    lines = [r.select(F.lit(name).alias("table_name"), "*") for name, r in _reports(spark, sf)]
    shown = plain_result(F.col("result_json")).alias("result")
    return reduce(DataFrame.unionByName, lines).select("table_name", "severity", "test_name", shown)


def stored_audit(spark: SparkSession, sf: str, suites: list[str]) -> DataFrame:
    """Reports of the named suites appended to an audit log and read back."""
    path = f"{work_folder(spark)}/audit-{uuid.uuid4().hex}"
    for table, report in _reports(spark, sf, suites):
        for _ in range(suites.count(table)):
            audit_append_to(report, table, path, star.SECOND_RUN)
    return audit_log(spark, path, now=star.SECOND_RUN)


def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict per suite, as written and strict, read from the stored reports."""
    names = [suite.table for suite, _ in SUITES]
    error = F.count_if(F.col("severity") == "ERROR").alias("errors")
    any_case = F.count_if(F.upper("severity") == "ERROR").alias("strict_errors")
    found = stored_audit(spark, sf, names).groupBy("table_name").agg(error, any_case)
    every = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("table_name"))
    seen = every.join(found, "table_name", "left").fillna(0)
    return seen.select("table_name", "errors", (F.col("errors") == 0).alias("passed"), "strict_errors", (F.col("strict_errors") == 0).alias("strict_passed"))


def audit_append(spark: SparkSession, sf: str) -> DataFrame:
    """What the contact suite adds to the audit log, read back after it was added twice."""
    stored = stored_audit(spark, sf, [QC.SUITE.table] * 2)
    return stored.select("audit_timestamp", "table_name", "severity", "test_name", plain_result(F.col("result_json")).alias("result"))


def dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.orphans(
        orders_loaded(spark, sf, "order_id"),
        order_ids_of_items(spark, sf),
        contact_of(spark, sf),
        event_of(spark, sf),
    )


def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    v = view_queries()
    return monitor.reconcile(
        v["monthly_revenue_by_ticket_type"](spark, sf), v["revenue_by_sales_channel"](spark, sf)
    )


def quality_queries() -> dict[str, Query]:
    orders, items, contact, event = QO.SUITE, QL.SUITE, QC.SUITE, QE.SUITE
    return {
        "dq_orders_nulls": _check(orders, "nulls", orders=orders_of),
        "dq_orders_duplicates": _check(
            orders, "duplicates", orders=lambda s, d: twice(orders_of(s, d), orders_loaded(s, d))
        ),
        "dq_orders_timestamps": _check(orders, "timestamps", orders=orders_of),
        "dq_orders_currency": _check(orders, "currency", orders=unclean_currency),
        "dq_orders_status": _check(orders, "status", orders=orders_of),
        "dq_orders_financial": _check(orders, "financial", orders=orders_of),
        "dq_orders_missing": _check(orders, "missing", orders=orders_loaded, raw=raw_ids),
        "dq_orders_extra": lambda s, d: QO.extra_orders(
            {
                "orders": orders_of(s, d, "order_id"),
                "raw": loaded(star.documents(s, d, ("id", "createdDate"))),
            }
        ),
        "dq_orders_no_items": _check(
            orders, "no_items", orders=orders_of, items=order_ids_of_items
        ),
        "dq_orders_no_contact": _check(
            orders, "no_contact", orders=orders_of, contact=contact_loaded
        ),
        "dq_orders_multi_contact": _check(orders, "multi_contact", contact=contacts_twice),
        "dq_orders_rollup": _check(orders, "rollup", orders=orders_of),
        "dq_orders_web_mix": _check(orders, "web_mix", orders=orders_of),
        "dq_orders_status_counts": _check(orders, "status_counts", orders=orders_of),
        "dq_line_items_duplicates": lambda s, d: QL.table_duplicates(
            {"items": items_of(s, d, *LI.KEYS)}, strict=True
        ),
        "dq_line_items_missing": _check(items, "missing", items=lambda s, d: items_loaded(s, d, *LI.KEYS), raw=raw_rate_keys),
        "dq_line_items_extra": lambda s, d: QL.extra_keys(
            {"items": items_of(s, d, *LI.KEYS), "raw": lines_loaded(s, d, KEY_FIELDS)}
        ),
        "dq_line_items_keys": _check(items, "keys", items=item_columns("surrogate_key")),
        "dq_line_items_nulls": _check(items, "nulls", items=item_columns(*LI.KEYS, *QL.NUMBERS)),
        "dq_line_items_negatives": _check(items, "negatives", items=item_columns(*QL.PRICED)),
        "dq_line_items_math": _check(items, "math", items=item_columns(*QL.PRICED)),
        "dq_serial_tokens": _check(items, "serials", items=item_columns("surrogate_key", *LI.KEYS, "serials")),
        "dq_raw_fanout": lambda s, d: QL.raw_fanout({"raw": raw_rate_keys(s, d)}, strict=True),
        "dq_contact_nulls": _check(contact, "nulls", contact=contact_of),
        "dq_contact_duplicates": _check(contact, "duplicates", contact=contacts_twice),
        "dq_contact_keys": _check(contact, "keys", contact=contact_of),
        "dq_contact_unknown": _check(contact, "unknown", contact=contact_of),
        "dq_contact_flag": _check(contact, "flag", contact=contacts_masked),
        "dq_contact_email": _check(contact, "email", contact=contact_of),
        "dq_contact_email_case": _check(contact, "email_case", contact=contacts_masked),
        "dq_contact_missing": _check(contact, "missing", contact=contact_loaded, raw=raw_ids),
        "dq_contact_dup_summary": _check(contact, "dup_ids", contact=contact_of),
        "dq_email_dup_summary": _check(contact, "dup_emails", contact=contact_of),
        "dq_event_duplicates": _check(event, "duplicates", event=event_of),
        "dq_event_missing": _check(event, "missing", event=event_loaded, raw=raw_schedules),
        "dq_event_attributes": _check(event, "attributes", event=event_of),
        "dq_event_keys": _check(event, "keys", event=event_of),
        "dq_event_null_identity": _check(event, "null_identity", event=event_of),
        "dq_event_guard": _check(event, "guard", event=event_of, raw=raw_schedules),
        "dq_event_guard_unguarded": _check(event, "guard", event=event_unguarded, raw=raw_schedules),
        "dq_report": dq_report,
        "dq_gate": dq_gate,
        "audit_append": audit_append,
        "dq_orphans": dq_orphans,
        "dq_surrogate_duplicates": lambda s, d: monitor.surrogate_duplicates(
            items_of(s, d, "surrogate_key"), contacts_twice(s, d), event_of(s, d)
        ),
        "dq_monitor": lambda s, d: monitor.monitor(
            contact_of(s, d), star.history(s, d, ("id", "modifiedDate"))
        ),
        "dq_reconcile": dq_reconcile,
        "dq_domain": lambda s, d: monitor.domain(
            orders_of(s, d, "salesoffice_name"), sales_of(s, d)
        ),
    }


# Sample question log: the text an event stands for, by event_id % 12.
PROJECT, DATASET = "analytics-demo", "governed"


def query_log(spark: SparkSession, sf: str) -> DataFrame:
    events = star.table(spark, sf, "events", share=True)
    texts = F.array(*[F.lit(sql) for sql, _ in LOG])
    which = (F.col("event_id") % len(LOG)).cast("int")
    return events.select(F.col("event_id").alias("query_id"), F.get(texts, which).alias("sql"))


def governed_queries() -> dict[str, Query]:
    views = view_queries()
    copied = (
        "monthly_revenue_by_ticket_type",
        "revenue_by_sales_channel",
        "monthly_headcount_by_ticket_type",
        "visitor_count_by_sales_channel",
        "thirty_day_headcount",
        "membership_tabular",
    )
    return {
        "contact_masked": contacts_masked,
        "governed_orders": lambda s, d: governed.governed_orders(orders_of(s, d)),
        "governed_line_items": lambda s, d: governed.governed_line_items(items_of(s, d)),
        "governed_event": lambda s, d: governed.governed_event(event_of(s, d)),
        **{f"governed_{name}": views[name] for name in copied},
        "query_log_screen": lambda s, d: query_log_screen(query_log(s, d), PROJECT, DATASET),
    }


OFFICE, QUARTER, CHILD = "online sales ", 2, "Child (4-12)"
TICKET_HEAD = ("order_id", "created_date", "status")


def question_queries() -> dict[str, Query]:
    v = view_queries()

    def on_view(question, view: str, *args) -> Query:
        return lambda s, d: question(v[view](s, d), *args)

    def on_orders(question, *columns: str, args: tuple = ()) -> Query:
        return lambda s, d: question(orders_of(s, d, *columns), *args)

    start, end = clock.quarter_bounds(YEAR, QUARTER)
    channel, visitors = "revenue_by_sales_channel", "visitor_count_by_sales_channel"
    value = ("order_id", "status", "total")
    return {
        "q_ticket_revenue": lambda s, d: Q.ticket_revenue(
            orders_of(s, d, *TICKET_HEAD), typed_sales_of(s, d), start, end
        ),
        "q_revenue_quarter": on_orders(
            Q.revenue_quarter, *TICKET_HEAD, "total", args=(YEAR, QUARTER)
        ),
        "q_ticket_revenue_quarter": on_view(
            Q.ticket_revenue_quarter, "monthly_revenue_by_ticket_type", YEAR, QUARTER
        ),
        "q_headcount_quarter": on_view(
            Q.headcount_quarter, "monthly_headcount_by_ticket_type", CHILD, YEAR, QUARTER
        ),
        "q_office_revenue": on_view(Q.office_revenue, channel, OFFICE),
        "q_office_tickets": on_view(Q.office_tickets, channel, OFFICE),
        "q_office_visitors": on_view(Q.office_visitors, visitors, OFFICE),
        "q_top_membership": on_view(Q.top_membership, "membership_tabular"),
        "q_thirty_day_stats": on_view(Q.thirty_day_stats, "thirty_day_headcount"),
        "q_orders_yesterday": on_orders(
            Q.orders_yesterday, "order_id", "created_date", args=(AS_OF,)
        ),
        "q_orders_by_city": lambda s, d: Q.orders_by_city(
            contact_of(s, d), orders_of(s, d, "order_id")
        ),
        "q_attendance_by_visit_date": lambda s, d: Q.attendance_by_visit_date(
            event_of(s, d), sales_of(s, d)
        ),
        "q_orders_per_event": lambda s, d: Q.orders_per_event(event_of(s, d)),
        "q_orders_per_product": lambda s, d: Q.orders_per_product(typed_sales_of(s, d)),
        "q_event_duration": lambda s, d: Q.event_duration(event_of(s, d)),
        "q_revenue_by_product_safe": lambda s, d: Q.revenue_by_product_safe(
            orders_of(s, d, *value), typed_sales_of(s, d)
        ),
        "q_web_orders": on_orders(Q.web_orders, *value, "web_order", "salesoffice_name"),
        "q_revenue_by_currency": on_orders(Q.revenue_by_currency, *value, "currency"),
        "q_revenue_by_employee": on_orders(
            Q.revenue_by_employee,
            *value,
            "sales_person_id",
            "sales_person_firstname",
            "sales_person_lastname",
        ),
        "q_rate_type_breakdown": lambda s, d: Q.rate_type_breakdown(
            items_of(s, d, *Q.BREAKDOWN)
        ),
        "q_order_detail": on_orders(
            Q.order_detail, *value, "created_date", "salesoffice_name", "currency"
        ),
    }


def run_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Every local day with an order, taken as a day on which the snapshot is started."""
    days = orders_of(spark, sf, "created_date")
    return days.select(clock.local_date(F.col("created_date")).alias("run_date")).distinct()


def snapshot_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of each quarter that could be archived."""
    runs = run_dates(spark, sf).filter(snapshot.quarter_closed(F.col("run_date")))
    return snapshot.snapshot_metadata(runs, "orders").drop("snapshot_created_at")


def quarter_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    views = view_queries()
    return snapshot.quarter_snapshot(
        {name: partial(views[name], spark, sf) for name in snapshot.MEASURES}
    )


def snapshot_queries() -> dict[str, Query]:
    return {
        "snapshot_period": lambda s, d: snapshot.snapshot_period(run_dates(s, d)),
        "snapshot_guard": lambda s, d: snapshot.snapshot_guard(run_dates(s, d)),
        "snapshot_metadata": snapshot_metadata,
        "quarter_snapshot": quarter_snapshot,
    }


def all_queries() -> dict[str, Query]:
    found = {
        **view_queries(),
        **visit_queries(),
        **load_queries(),
        **quality_queries(),
        **governed_queries(),
        **question_queries(),
        **snapshot_queries(),
    }

    def plain(query: Query) -> Query:
        return lambda spark, sf: edge(query(spark, sf))

    return {name: plain(query) for name, query in found.items()}
