"""Time expressions. Timestamps without a zone stay without one; the session runs in UTC."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds as a UTC wall-clock timestamp."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp, zoned or not."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("bigint")).cast("timestamp_ntz")


def bucket(ts: Column, unit: str = "hour") -> Column:
    """Start of the hour, day, ... a timestamp falls in."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def hour_text(ts: Column) -> Column:
    """Hour key in text form, minutes and seconds zeroed."""
    return F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:mm:ss")


def iso_ts(text: Column) -> Column:
    """``2026-03-01T00:00`` or ``2026-03-01 00:00:00`` text to a timestamp, else null."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
    ).cast("timestamp_ntz")


def to_ts(text: Column) -> Column:
    """Lenient text to timestamp; unreadable text gives null."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def weekday0(ts: Column) -> Column:
    """Weekday number, Monday = 0."""
    return F.weekday(ts)


def day_of_year(ts: Column) -> Column:
    return F.dayofyear(ts)


def weekday_name(ts: Column, pad: int = 9) -> Column:
    """English weekday name, blank-padded on the right."""
    return F.rpad(F.date_format(ts, "EEEE"), pad, " ")


CALENDAR = {
    "year": F.year,
    "month": F.month,
    "day": F.day,
    "hour": F.hour,
    "week": iso_week,
    "weekday": weekday0,
    "day_of_year": day_of_year,
}


def calendar(ts: Column, parts: dict[str, str]) -> dict[str, Column]:
    """``{output name: part}`` to ``{output name: integer column}``."""
    return {name: CALENDAR[part](ts).cast("int") for name, part in parts.items()}


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a cyclic quantity."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def day_bounds(first: Column, last: Column) -> tuple[Column, Column, Column]:
    """Epoch second of the first day's start, of the last day's last second, and the day count."""
    start = F.unix_timestamp(F.to_date(first).cast("timestamp"))
    stop = F.unix_timestamp(F.date_add(F.to_date(last), 1).cast("timestamp")) - 1
    return start, stop, F.datediff(F.to_date(last), F.to_date(first)) + 1


def run_time(instant) -> Column:
    """One instant for a whole run, rendered as text. ``instant`` is an aware ``datetime``."""
    from datetime import timezone

    return F.lit(instant.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
