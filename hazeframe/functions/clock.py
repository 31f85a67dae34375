"""Local-time calendar fields of UTC instants."""

from __future__ import annotations

import datetime as dt
import math
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe.functions.numeric import as_column
from hazeframe.schema import LOCAL_ZONE

# Fixed values.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HEATING_MONTHS = (10, 11, 12, 1, 2, 3)
WINTER_MONTHS = ("11", "12", "01", "02")
SUMMER_MONTHS = ("06", "07", "08")


def local_time(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in `zone`. Only for calendar fields: two instants can share one wall clock."""
    return F.from_utc_timestamp(as_column(ts), zone)


def local_date(ts: Column | str) -> Column:
    return F.to_date(local_time(ts))


def local_month(ts: Column | str) -> Column:
    """`yyyy-MM` of the local date."""
    return F.date_format(local_time(ts), "yyyy-MM")


def local_hour(ts: Column | str) -> Column:
    return F.hour(local_time(ts))


def local_weekday(ts: Column | str) -> Column:
    """Monday = 0."""
    return F.weekday(local_time(ts))


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(local_time(ts), "EEEE")


def is_weekend(ts: Column | str) -> Column:
    return (local_weekday(ts) >= 5).cast("int")


def is_heating_season(ts: Column | str) -> Column:
    return F.month(local_time(ts)).isin(*HEATING_MONTHS).cast("int")


def on_circle(value: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of a cyclic field."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with a trailing Z, for exports."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_start_utc(day: dt.date, zone: str = LOCAL_ZONE) -> dt.datetime:
    """The instant at which a local day begins, with its zone: PySpark reads a time without one in the driver's own."""
    start = dt.datetime.combine(day, dt.time(), tzinfo=ZoneInfo(zone))
    return start.astimezone(dt.timezone.utc)
