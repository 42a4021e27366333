"""Epoch-microsecond arithmetic, bucket starts, display labels and local time.

The session time zone must be UTC (``session.prepare`` sets it).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLI_US = 1_000
SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
BUCKET_US = 15 * MINUTE_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US

MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
LOCAL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_us(text: str) -> int:
    """Driver-side twin of :func:`parse_minute` for job parameters ("na" is the epoch)."""
    if text == "na":
        return 0
    moment = datetime.strptime(text, "%Y-%m-%d %H:%M").replace(tzinfo=timezone.utc)
    return int(moment.timestamp()) * SECOND_US


def bucket_start(time: Column, width_us: int = BUCKET_US, origin_us: int = 0) -> Column:
    """Start of the half-open bucket ``[start, start + width)`` that holds ``time``."""
    return time - F.pmod(time - F.lit(origin_us), F.lit(width_us).cast("long"))


def minute_label(time: Column) -> Column:
    return F.date_format(F.timestamp_micros(time), MINUTE_FORMAT)


def hour_label(time: Column) -> Column:
    return F.substring(minute_label(time), 1, 13)


def day_label(time: Column) -> Column:
    return F.date_format(F.timestamp_micros(time), "yyyy-MM-dd")


def day_of_millis(time: Column) -> Column:
    return F.date_format(F.timestamp_millis(time), "yyyy-MM-dd")


def parse_minute(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` to epoch µs; "na" is the epoch, anything unreadable is null."""
    parsed = F.unix_micros(F.try_to_timestamp(text, F.lit(MINUTE_FORMAT)))
    return F.when(text == "na", F.lit(0).cast("long")).otherwise(parsed)


def hour_end(hour: Column) -> Column:
    """End of an hour given as ``yyyy-MM-dd HH``, in epoch µs."""
    start = F.to_timestamp(F.concat(hour, F.lit(":00:00")), LOCAL_FORMAT)
    return F.unix_micros(start) + F.lit(HOUR_US)


def day_end(day: Column) -> Column:
    """End of a day given as ``yyyy-MM-dd``, in epoch µs."""
    start = F.to_timestamp(F.concat(day, F.lit(" 00:00:00")), LOCAL_FORMAT)
    return F.unix_micros(start) + F.lit(DAY_US)


def localize(time: Column, zone: Column) -> Column:
    """Epoch µs as a wall-clock string in ``zone`` (daylight saving included)."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_micros(time), zone), LOCAL_FORMAT)


def shift_day(day: Column, days: int) -> Column:
    return F.date_format(F.date_add(F.to_date(day), days), "yyyy-MM-dd")


def bucket_labels(start: str = "starttime", end: str = "endtime") -> dict[str, Column]:
    """The four display columns every bucket fact carries."""
    # All start labels are cuts of one formatted string, which is then built once per row.
    startdt = minute_label(F.col(start))
    return {
        "startdt": startdt,
        "enddt": minute_label(F.col(end)),
        "starthr": F.substring(startdt, 1, 13),
        "startday": F.substring(startdt, 1, 10),
    }
