"""Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "airline", "blank_to_null", "clip", "day_bounds", "distance_km", "epoch", "hour_block", "iso_time", "iso_weekday", "minutes",
    "minutes_exact", "real_date", "unquote", "zero_to_null", "years",
]


def blank_to_null(c: Column) -> Column:
    """NULL for an empty string."""
    return F.nullif(c, F.lit(""))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def clip(c: Column, n: int) -> Column:
    """At most n characters of the trimmed text; NULL if nothing is left."""
    return blank_to_null(F.substring(F.trim(c), 1, n))


def unquote(c: Column) -> Column:
    """Trimmed, then without outer single quotes, then without outer double quotes."""
    c = F.regexp_replace(F.trim(c), "^'+|'+$", "")
    return F.regexp_replace(c, '^"+|"+$', "")


def epoch(c: Column) -> Column:
    """Seconds since 1970 as a UTC timestamp."""
    return F.timestamp_seconds(c)


def iso_time(c: Column) -> Column:
    """ISO text with or without seconds and offset; UTC if it has none; NULL if it is none."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd[' ']['T']HH:mm[:ss][XXX]")), c.try_cast("timestamp"))


def real_date(c: Column) -> Column:
    """The date that the first ten characters name, as year, month and day, if it exists; else NULL."""
    day = F.substring(F.trim(c), 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(day, F.lit("yyyy-M-d")).cast("date"))


def iso_weekday(c: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(c) + 1


def _seconds(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def minutes(a: Column, b: Column) -> Column:
    """Minutes from a to b, to one decimal, halves away from zero."""
    return F.round(_seconds(a, b) / 60.0, 1)


def minutes_exact(a: Column, b: Column) -> Column:
    """The same, rounded as the nearest decimal of the binary quotient, halves to even.

    Only seconds of 3 modulo 6 are near a half. Whether the double below or above it was meant
    shows in t * 60 - s, which is exact when t is split into 20 binary places and the rest.
    """
    s = F.abs(_seconds(a, b))
    t = s / 60.0
    high = F.floor(t * 1048576.0) / 1048576.0
    error = (20.0 * high - (s / 3).cast("long")) + 20.0 * (t - high)
    tenths = F.floor(s / 6)
    even = tenths + tenths % 2
    size = F.when(s % 6 == 3, F.when(error < 0, tenths).when(error > 0, tenths + 1).otherwise(even) / 10.0).otherwise(F.round(t, 1))
    return F.when(_seconds(a, b) < 0, -size).otherwise(size)


def years(since: Column, day: Column) -> Column:
    return F.round(F.datediff(day, since) / 365.25, 1)


def hour_block(ts: Column) -> Column:
    """The quarter of the day, as 00-06, 06-12, 12-18 or 18-24; the first for NULL."""
    lo = F.coalesce(F.floor(F.hour(ts) / 6) * 6, F.lit(0))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(two(lo), F.lit("-"), two(lo + 6))


def airline(callsign: Column) -> Column:
    return F.substring(callsign, 1, 3)


def day_bounds(day: Column) -> Column:
    """First and last second of a day."""
    start = day.cast("timestamp")
    return F.struct(start.alias("begin"), (start + F.expr("INTERVAL 86399 SECONDS")).alias("end"))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
