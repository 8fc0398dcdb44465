"""Quarterly snapshots: freeze every measure once a quarter has closed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.operators.upsert import TableAssertion

# Archive name and the measures an archive must hold.
ARCHIVE_NAME = "dashboard_archive_%d_q%d"
MEASURES = (
    "average_daily_revenue",
    "median_daily_revenue",
    "membership_summary",
    "membership_tabular",
    "monthly_headcount_by_ticket_type",
    "monthly_revenue_by_ticket_type",
    "monthly_ticket_revenue",
    "refund_void_rate",
    "revenue_by_sales_channel",
    "seven_day_headcount",
    "thirty_day_headcount",
    "revenue_per_visitor",
    "transactions_daily_average",
    "transactions_daily_median",
    "transactions_value_average",
    "transactions_value_median",
    "visitor_count_by_sales_channel",
    "yesterdays_tickets_sold",
)

Measure = Callable[[], DataFrame]


def period(run_date: Column) -> dict[str, Column]:
    """The quarter that holds the day before the run."""
    day = F.date_sub(run_date, 1)
    return {
        "archive_date": day,
        "archive_year": F.year(day),
        "archive_quarter": F.quarter(day),
        "archive_name": F.format_string(ARCHIVE_NAME, F.year(day), F.quarter(day)),
    }


def snapshot_period(runs: DataFrame, run_date: str = "run_date") -> DataFrame:
    return runs.select(run_date, *[c.alias(n) for n, c in period(F.col(run_date)).items()])


def quarter_closed(run_date: Column) -> Column:
    day = F.date_sub(run_date, 1)
    return day == clock.quarter_end(day)


def snapshot_guard(runs: DataFrame, run_date: str = "run_date") -> DataFrame:
    """Which run dates may take a snapshot."""
    return runs.select(run_date, quarter_closed(F.col(run_date)).alias("allowed"))


def snapshot_metadata(
    runs: DataFrame, source: str, objects: int = len(MEASURES), run_date: str = "run_date"
) -> DataFrame:
    """One descriptive row per snapshot."""
    p = period(F.col(run_date))
    return runs.select(
        *[p[c].alias(c) for c in ("archive_year", "archive_quarter", "archive_date")],
        F.current_timestamp().alias("snapshot_created_at"),
        F.lit(source).alias("source_dataset"),
        F.lit(objects).cast("long").alias("archived_object_count"),
    )


def quarter_snapshot(measures: Mapping[str, Measure]) -> DataFrame:
    """(view_name, rows) of every measure, as a snapshot would store them."""
    parts = [
        make().agg(F.count("*").alias("rows")).select(F.lit(name).alias("view_name"), "rows")
        for name, make in measures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def snapshot(
    spark: SparkSession, measures: Mapping[str, Measure], as_of: dt.date, root: str, source: str
) -> DataFrame:
    """Write every measure below ``root/<archive>/`` with a metadata table; return a summary.

    Refused unless ``as_of`` is the day after a quarter's end and all measures exist.
    A repeated run replaces the archive of the same quarter.
    """
    missing = sorted(set(MEASURES) - set(measures))
    if missing:
        raise TableAssertion(f"measures missing from the archive: {missing}")
    day = as_of - dt.timedelta(days=1)
    quarter = (day.month + 2) // 3
    if clock.quarter_bounds(day.year, quarter)[1] != as_of:
        raise TableAssertion(f"{day} is not the last day of a quarter")
    name = ARCHIVE_NAME % (day.year, quarter)
    home = f"{root.rstrip('/')}/{name}"
    for view in MEASURES:
        measures[view]().write.mode("overwrite").parquet(f"{home}/{view}")
    run = spark.range(1).select(F.lit(as_of).alias("run_date"))
    snapshot_metadata(run, source).write.mode("overwrite").parquet(f"{home}/snapshot_metadata")
    return run.select(
        F.lit(name).alias("archive_dataset_created"),
        F.lit(day).alias("quarter_end_date"),
        F.lit(len(MEASURES)).alias("views_archived"),
        F.current_timestamp().alias("completed_at"),
    )
