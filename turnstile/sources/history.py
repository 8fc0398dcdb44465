"""Every version of an order, kept once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.functions.fixed import ZONE

VERSION = ("id", "modifiedDate")


def history_fresh(
    raw: DataFrame, hist: DataFrame, as_of: dt.datetime | None = None, zone: str = ZONE
) -> DataFrame:
    """Versions not seen yet, stamped. Only these are appended to the stored history.

    Plain equality on purpose: a NULL modifiedDate matches nothing, so such a
    document is added on every run. The history side is two columns wide and
    distinct, so a version stored many times cannot crowd one task.
    """
    now = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return (
        raw.join(hist.select(*VERSION).distinct(), list(VERSION), "left_anti")
        .select(*raw.columns)
        .withColumn("ingestion_timestamp", now)
        .withColumn("ingestion_date", clock.local_date(now, zone))
    )


def history_merge(
    raw: DataFrame, hist: DataFrame, as_of: dt.datetime | None = None, zone: str = ZONE
) -> DataFrame:
    """History after the batch: insert-if-absent on (id, modifiedDate)."""
    return hist.unionByName(history_fresh(raw, hist, as_of, zone))


def _rank() -> Column:
    """Modification time, then ingestion time, as one number; NULL comes first.

    Microseconds have at most 18 digits. A number keeps the aggregate on hashing;
    a pair in a struct would make Spark sort the whole history.
    """

    def micros(name: str) -> Column:
        return F.coalesce(F.unix_micros(name), F.lit(-(10**17))).cast("decimal(19,0)")

    rank = micros("modifiedDate") * F.lit(10**18).cast("decimal(19,0)") + micros("ingestion_timestamp")
    return rank.cast("decimal(38,0)")


def of_newest(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows that come from the newest of the given versions of their order.

    Both hold id, modifiedDate and ingestion_timestamp.

    Needs ``ingestion_timestamp``: without it, versions with equal or no modification
    time would tie and all count.

    The newest version is found on narrow columns with a combinable aggregate and
    then joined back, so whole documents are never gathered per order.
    """
    ranked = rows.withColumn("_rank", _rank())
    newest = versions.select("id", _rank().alias("_rank")).groupBy("id").agg(F.max("_rank").alias("_rank"))
    newest = newest.select(F.col("id").alias("_id"), F.col("_rank").alias("_newest"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("_rank") == F.col("_newest"))
    return ranked.join(newest, same, "left_semi").drop("_rank")


def history_latest(hist: DataFrame) -> DataFrame:
    """Rows of the newest version of each order."""
    return of_newest(hist, hist)
