"""Checks on events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.operators.event import GRAIN, SCHEMA, varies
from turnstile.operators.quality import names
from turnstile.operators.quality.report import (
    FrameCheck,
    KeyRows,
    KeyTotals,
    RowCheck,
    Side,
    Suite,
    Tables,
    distinct_keys,
    lacks,
    one,
)
from turnstile.operators.unnest import unnest_schedules
from turnstile.operators.upsert import duplicates, lacking


def missing_schedules(t: Tables) -> DataFrame:
    """Delivered schedules without an event. Plain equality: a NULL part never matches."""
    wanted = unnest_schedules(t["raw"]).select(*GRAIN).distinct()
    return lacking(wanted, t["event"], GRAIN)


def _attributes(t: Tables) -> DataFrame:
    """Groups with several names or types. The grain itself fixes date and start."""
    return (
        t["event"]
        .groupBy(*GRAIN)
        .agg(
            F.count_distinct("event_name").alias("names"),
            F.count_distinct("event_type").alias("types"),
        )
        .filter("names > 1 or types > 1")
        .select(
            "schedule_id",
            "names",
            "types",
            F.col("event_date").isNotNull().cast("long").alias("dates"),
            F.col("event_start").isNotNull().cast("long").alias("starts"),
        )
    )


def _keys(t: Tables) -> DataFrame:
    return t["event"].agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("event_surrogate_key").alias("distinct_keys"),
    )


def _no_identity() -> Column:
    return F.col("schedule_id").isNull() & F.col("event_date").isNull() & F.col("event_start").isNull()


def _guard(t: Tables) -> DataFrame:
    """Ids reused across schedules that the table holds under one schedule only."""
    reused = (
        unnest_schedules(t["raw"])
        .filter("event_id is not null")
        .groupBy("event_id")
        .agg(varies(*GRAIN).alias("many"))
        .filter("many")
    )
    return (
        t["event"]
        .join(reused, "event_id", "left_semi")
        .groupBy("event_id")
        .agg(varies(*GRAIN).alias("many"))
        .filter("not many")
        .select("event_id", F.lit(1).cast("long").alias("distinct_schedules_in_event_table"))
    )


def _grain() -> list[Column]:
    return [F.col(c) for c in GRAIN]


SUITE = Suite(
    "event",
    names.EVENT,
    {
        "duplicates": FrameCheck(lambda t: duplicates(t["event"], GRAIN)),
        "missing": FrameCheck(missing_schedules),
        "attributes": FrameCheck(_attributes),
        "keys": FrameCheck(_keys),
        "null_identity": RowCheck(
            "event", _no_identity, lambda: [F.col(c) for c in SCHEMA.names]
        ),
        "guard": FrameCheck(_guard),
    },
    sides={
        "grain": {"event": Side(_grain, one("n0")), "raw": Side(_grain, one("n1"))},
        "surrogate": {"event": Side(lambda: [F.col("event_surrogate_key")], one("n0"))},
    },
    fused={
        "duplicates": KeyRows("grain", lambda: F.col("n0") > 1, lambda: [F.col("n0").alias("cnt")]),
        "missing": KeyRows("grain", lambda: (F.col("n1") > 0) & lacks("n0")),
        "keys": KeyTotals("surrogate", *distinct_keys("distinct_keys")),
    },
    lines={"raw": unnest_schedules},
)
