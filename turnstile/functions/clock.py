"""Business calendar: local days, half-open ranges, quarters."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnstile.functions.fixed import ZONE


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def local_date(ts: Column, zone: str = ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_midnight(day: str | dt.date, zone: str = ZONE) -> dt.datetime:
    """The UTC instant at which a local day starts."""
    return dt.datetime.combine(as_date(day), dt.time(), ZoneInfo(zone)).astimezone(dt.timezone.utc)


def on_local_days(ts: Column, start: str | dt.date, end: str | dt.date, zone: str = ZONE) -> Column:
    """start <= local date < end, written on the raw instant so the scan can use it.

    A predicate on the computed local date is not pushed to Parquet; two instants are.
    """
    return (ts >= F.lit(local_midnight(start, zone))) & (ts < F.lit(local_midnight(end, zone)))


def in_local_year(ts: Column, year: int, zone: str = ZONE) -> Column:
    return on_local_days(ts, dt.date(year, 1, 1), dt.date(year + 1, 1, 1), zone)


def in_year(day: Column, year: int) -> Column:
    return (day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MONTH")


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMMM yyyy")


def quarter_bounds(year: int, quarter: int) -> tuple[dt.date, dt.date]:
    """First day of a quarter and of the one after it."""
    first = dt.date(year, 3 * quarter - 2, 1)
    after = dt.date(year + 1, 1, 1) if quarter == 4 else dt.date(year, 3 * quarter + 1, 1)
    return first, after


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "QUARTER"), 2))
