"""Normalised events: many lines point at one scheduled event; keep one row per event.

Lines are first counted per (schedule, start, event id). Everything after works on
those counts, which are as many as there are distinct schedules and ids, so a
schedule that a third of all lines point at is combined before it moves.

Aggregates over raw lines keep to fixed-width buffers (numbers, instants): with a text
or struct in the buffer Spark sorts every line instead of hashing it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import text
from turnstile.operators.unnest import unnest_events, unnest_schedules
from turnstile.operators.upsert import duplicates, upsert
from turnstile.sources.schema import DAY, LONG, TEXT, WHEN, record

SCHEMA: T.StructType = record(
    event_surrogate_key=TEXT,
    event_id=LONG,
    event_type=TEXT,
    event_name=TEXT,
    event_date=DAY,
    event_start=WHEN,
    event_end=WHEN,
    schedule_id=LONG,
    order_id=LONG,
)
GRAIN = ("schedule_id", "event_date", "event_start")
TRACKED = ("event_id", "event_type", "event_name", "order_id", "event_end")


def sched_key() -> Column:
    """Schedule identity as text; a missing part has a marker of its own."""
    parts = [F.concat(text.marked(F.col(c), "MISSING"), F.lit("|")) for c in GRAIN]
    return F.concat(F.lit("SCHED:"), *parts)


def several(column: str) -> Column:
    """More than one distinct non-NULL value, without keeping the values."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))


def varies(*columns: str) -> Column:
    """More than one distinct tuple, a NULL part counting as a value of its own."""
    out = F.lit(False)
    for c in columns:
        some = F.count(c)
        out = out | several(c) | ((some > 0) & (some < F.count("*")))
    return out


def event_counts(raw: DataFrame) -> DataFrame:
    """One row per schedule and event id with its line count and attributes."""
    return (
        unnest_events(raw)
        .groupBy(*GRAIN, "event_id", "event_type", "event_name")
        .agg(
            F.count("*").alias("lines"),
            F.max("event_end").alias("event_end"),
            F.min("order_id").alias("order_id"),
        )
        .groupBy(*GRAIN, "event_id")
        .agg(
            F.sum("lines").alias("lines"),
            F.min("event_type").alias("event_type"),
            F.min("event_name").alias("event_name"),
            F.max("event_end").alias("event_end"),
            F.min("order_id").alias("order_id"),
        )
        .withColumn("sched_key", sched_key())
    )


def event_dedup_key(raw: DataFrame, guard: bool = True) -> DataFrame:
    """Counts with the key that decides which of them are one event.

    The event id is the key unless it is missing, sits beside another id on its
    schedule, or is reused on other schedules; the schedule is the key then. Both are read off
    the counted rows, one for each schedule and id, so the lines are scanned once. Without the
    guard any id is the key, as in tables loaded before ids were found to be reused.
    """
    if not guard:
        key = F.coalesce(F.col("event_id").cast("string"), F.col("sched_key"))
        return event_counts(raw).withColumn("dedup_key", key)
    by_schedule = Window.partitionBy("sched_key")
    # a missing id is compared with nothing: each such row is a group of its own
    by_id = Window.partitionBy("event_id", F.when(F.col("event_id").isNull(), F.col("sched_key")))
    counts = event_counts(raw)
    shares = F.coalesce(F.min("event_id").over(by_schedule) != F.max("event_id").over(by_schedule), F.lit(False))
    counts = counts.withColumn("_shares", shares).withColumn("_slots", F.count("*").over(by_id))
    own = ~F.col("_shares") & (F.col("_slots") == 1)
    key = F.coalesce(F.when(own, F.col("event_id").cast("string")), F.col("sched_key"))
    return counts.withColumn("dedup_key", key).drop("_shares", "_slots")


def _canonical() -> Column:
    """Most frequent id, the smallest on a tie, NULL before any number.

    Each id occurs once per dedup key in the counted rows, so no ranking is needed.
    """
    return F.min_by("event_id", F.struct(-F.col("lines"), F.col("event_id")))


def event_canonical_id(raw: DataFrame) -> DataFrame:
    return event_dedup_key(raw).groupBy("dedup_key").agg(_canonical().alias("canonical_event_id"))


def event_dedup(raw: DataFrame, guard: bool = True) -> DataFrame:
    """One row per dedup key: latest end, smallest of each other attribute."""
    picks = [
        F.min(c).alias(c)
        for c in ("event_type", "event_name", "event_date", "event_start", "schedule_id", "order_id")
    ]
    return event_dedup_key(raw, guard).groupBy("dedup_key").agg(
        _canonical().alias("event_id"), *picks, F.max("event_end").alias("event_end")
    )


def event_transform(raw: DataFrame, strict: bool = False, guard: bool = True) -> DataFrame:
    """Rows to load.

    A missing id beside one id on the same schedule gives two dedup keys for one
    grain, which the load's assertion then reports. ``strict`` merges those by grain.
    Without ``guard`` an id stands for one event wherever it occurs; the event checks find such tables.
    """
    rows = event_dedup(raw, guard)
    if strict:
        rows = rows.groupBy(*GRAIN).agg(
            F.min("dedup_key").alias("dedup_key"),
            *[F.min(c).alias(c) for c in ("event_id", "event_type", "event_name", "order_id")],
            F.max("event_end").alias("event_end"),
        )
    return rows.withColumn(
        "event_surrogate_key", text.stable_key(F.col("dedup_key"))
    ).select(*SCHEMA.names)


def event_upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, GRAIN, TRACKED, null_safe=True)


def repeated(event: DataFrame) -> DataFrame:
    return duplicates(event, GRAIN)


def event_latest_end(raw: DataFrame) -> DataFrame:
    """The schedule row with the latest end at each grain (smallest id on a tie)."""
    return (
        unnest_schedules(raw)
        .groupBy(*GRAIN, "event_id")
        .agg(F.max("event_end").alias("event_end"))
        .groupBy(*GRAIN)
        .agg(F.min(F.struct(_descending("event_end"), F.col("event_end"), F.col("event_id"))).alias("r"))
        .select(*GRAIN, F.col("r.event_end").alias("event_end"), F.col("r.event_id").alias("raw_event_id"))
    )


def _descending(column: str) -> Column:
    """Sorts late instants first and NULL last."""
    return F.coalesce(-F.unix_micros(column), F.lit(2**63 - 1)).alias("late_first")
