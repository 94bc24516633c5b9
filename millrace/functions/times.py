"""Time conversions. Every session runs in UTC (see ``millrace.session``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def from_epoch_seconds(seconds: Column) -> Column:
    """P-8: a cast, which holds absurd values at the end of the range instead of failing."""
    return seconds.cast("timestamp")


def from_epoch_micros(micros: Column) -> Column:
    """P-13: microseconds, cut to whole milliseconds."""
    return F.date_trunc("millisecond", F.timestamp_micros(micros))


def from_iso(text: Column) -> Column:
    """P-11: ISO text with T and Z, cut to whole milliseconds; unreadable text gives NULL."""
    plain = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return F.date_trunc("millisecond", plain.try_cast("timestamp"))


def floor_div(value: Column, step: int) -> Column:
    """Integer division towards minus infinity."""
    return ((value - F.pmod(value, F.lit(step).cast("bigint"))) / F.lit(step)).cast("bigint")


UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def interval_micros(interval: str) -> int:
    """Microseconds in an interval text such as '7 days'."""
    number, unit = interval.split()
    return int(float(number) * UNITS[unit.rstrip("s")] * 1_000_000)
