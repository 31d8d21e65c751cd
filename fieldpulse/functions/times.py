"""Event-time expressions. All of them work in batch and in streaming."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)


def utc_ntz(instant: Column) -> Column:
    """A zoned timestamp as its UTC wall clock, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def utc_literal(at: datetime) -> Column:
    """A UTC wall-clock time as a foldable literal."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def bin_start(at: Column, size: timedelta) -> Column:
    """Start of the half-open bin [start, start + size) that holds ``at``; null for null, so no row is filtered out."""
    past = F.pmod(micros_between(utc_literal(EPOCH), at), F.lit(size // timedelta(microseconds=1)))
    return at - F.lit(timedelta(microseconds=1)) * past


def floor_to(at: datetime, size: timedelta) -> datetime:
    return EPOCH + (at - EPOCH) // size * size


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)
