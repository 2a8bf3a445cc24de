"""Interval lengths, bucket starts and display time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import DISPLAY_OFFSET_HOURS, INTERVAL_SECONDS


def interval_seconds(name: Column) -> Column:
    """Seconds of an interval name; NULL for an unknown name."""
    lengths = F.lit(None).cast("bigint")
    for label, seconds in INTERVAL_SECONDS.items():
        lengths = F.when(name == label, F.lit(seconds).cast("bigint")).otherwise(lengths)
    return lengths


def bucket_start(at: Column, seconds: Column | int) -> Column:
    """Start of the epoch-aligned bucket that holds ``at``."""
    width = F.lit(seconds) if isinstance(seconds, int) else seconds
    epoch = F.unix_seconds(at)
    return F.timestamp_seconds(epoch - F.pmod(epoch, width))


def local_time(at: Column, hours: int = DISPLAY_OFFSET_HOURS) -> Column:
    """Shift a UTC time for display."""
    return at + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
