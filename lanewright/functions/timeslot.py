"""Clock and calendar expressions. Timestamps are naive local wall-clock values; run with a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_MINUTES = 30
DAY_SECONDS = 86_400
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
SLOTS = tuple(f"{h:02d}{m:02d}" for h in range(24) for m in range(0, 60, SLOT_MINUTES))


def slot_of_minutes(minute_of_day: Column) -> Column:
    floored = (F.floor(minute_of_day / SLOT_MINUTES) * SLOT_MINUTES).cast("int")
    return F.format_string("%02d%02d", F.floor(floored / 60).cast("int"), floored % 60)


def slot(ts: Column) -> Column:
    """Half-hour slot "HHMM" of a timestamp; the date is ignored."""
    return F.when(ts.isNotNull(), slot_of_minutes(F.hour(ts) * 60 + F.minute(ts)))


def clock_seconds(clock: Column) -> Column:
    """Seconds of the day of "HH:MM"; null where that doesn't parse."""
    part = F.split(clock, ":")
    return F.get(part, F.lit(0)).try_cast("int") * 3600 + F.get(part, F.lit(1)).try_cast("int") * 60


def slot_of_clock(clock: Column) -> Column:
    return F.when(clock_seconds(clock).isNotNull(), slot_of_minutes(F.floor(clock_seconds(clock) / 60)))


def clock_plus(clock: Column, seconds: Column) -> Column:
    """"HH:MM" later by seconds, wrapping at midnight."""
    at = F.pmod(clock_seconds(clock) + seconds, F.lit(DAY_SECONDS)).cast("int")
    return F.when(at.isNotNull(), F.format_string("%02d:%02d", F.floor(at / 3600).cast("int"), (F.floor(at / 60) % 60).cast("int")))


def weekday(date: Column) -> Column:
    """MON to SUN."""
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(date))


def month_bounds(month: str) -> tuple[Column, Column]:
    """First instant of a "YYYY-MM" month and of the next, as timestamps: the filter on them reaches the scan."""
    first = F.to_date(F.lit(f"{month}-01"))
    return first.cast("timestamp"), F.add_months(first, 1).cast("timestamp")


def in_month(ts: Column, month: str) -> Column:
    start, stop = month_bounds(month)
    return (ts >= start) & (ts < stop)


def is_fresh(sampled_at: Column, as_of: Column, zone: str = "America/New_York") -> Column:
    """Was the sample taken on the day ``as_of``? Text with an offset is moved to the zone, other values are local; bad ones are not fresh."""
    text = sampled_at.cast("string")
    has_offset = F.coalesce(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d{2}:\d{2}"), F.lit(False))
    aware = F.from_utc_timestamp(F.try_to_timestamp(text), zone)
    day = F.when(has_offset, F.to_date(aware)).otherwise(F.to_date(F.try_to_timestamp(text)))
    return F.coalesce(day == as_of, F.lit(False))


def path_date(path: Column) -> Column:
    """Date of a "date=YYYY-MM-DD" path part, or null."""
    found = F.regexp_extract(path, r"date=(\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", found).try_cast("date")


def path_month(path: Column) -> Column:
    """"YYYY-MM" in a file name, or null."""
    found = F.regexp_extract(path, r"(\d{4}-\d{2})(?!\d|-\d)", 1)
    return F.when(found != "", found)
