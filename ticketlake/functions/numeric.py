"""Rounding and elapsed time on zone-less timestamps, independent of the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, unscale: the binary rounding the marts are defined by."""
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970 on the wall clock; a fraction of a second is cut off."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end; negative when end comes first."""
    return epoch_second(end) - epoch_second(start)


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    return round_half_away(part.cast("double") / whole.cast("double"), digits)
