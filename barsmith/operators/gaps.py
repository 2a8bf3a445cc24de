"""Missing data and the requests that would fill it, as tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import interval_seconds
from ..vocabulary import MIN_GAP_SECONDS, REQUEST_ROWS
from .indicators import SILVER_KEYS
from .series import SEGMENT_ROWS, over_series


def _minus(at: Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(at) - seconds * 1_000_000)


def last_seen(candles: DataFrame) -> DataFrame:
    """Latest candle per symbol: the table itself is the marker of what was ingested."""
    return candles.groupBy("symbol").agg(F.max("open_time").alias("last_open_time"))


def downtime_gaps(
    candles: DataFrame, symbols: DataFrame, as_of: datetime, since: datetime | None = None,
    max_hours: int | None = None,
) -> DataFrame:
    """Range to backfill per symbol, from its last candle to ``as_of``; short gaps are skipped.

    A symbol never seen is due from ``since``, by default from the first candle of any symbol;
    its start is NULL where there is neither. ``max_hours`` cuts ranges to the last hours, for
    callers that fill the rest otherwise; nothing is cut by default.
    """
    now = F.lit(as_of).cast("timestamp")
    if since is None:
        begin = candles.agg(F.min("open_time").alias("begin")).scalar()
        listed = symbols.select("symbol").distinct().withColumn("begin", begin)
    else:
        listed = symbols.select("symbol").distinct().withColumn("begin", F.lit(since).cast("timestamp"))
    gaps = listed.join(last_seen(candles), "symbol", "left").select(
        "symbol", F.coalesce("last_open_time", "begin").alias("gap_start"), now.alias("gap_end")
    )
    if max_hours is not None:
        gaps = gaps.withColumn("gap_start", F.greatest("gap_start", _minus(F.col("gap_end"), max_hours * 3600)))
    seconds = (F.unix_micros("gap_end") - F.unix_micros("gap_start")) / 1_000_000
    return gaps.filter(F.col("gap_start").isNull() | (seconds >= MIN_GAP_SECONDS))


def missing_days(
    candles: DataFrame, as_of: datetime, symbols: DataFrame | None = None, since: datetime | None = None
) -> DataFrame:
    """Days without candles before ``as_of``, from the day of ``since``.

    Without ``since`` a symbol is due from its first day, and one without any candle from the
    first day of the table. ``symbols`` adds symbols that may have no candle at all.
    """
    days = candles.select("symbol", F.to_date("open_time").alias("day")).distinct()
    span = days.groupBy("symbol").agg(F.min("day").alias("first"))
    if symbols is not None:
        span = symbols.select("symbol").distinct().join(span, "symbol", "left")
    if since is not None:
        span = span.withColumn("first", F.lit(since).cast("timestamp").cast("date"))
    elif symbols is not None:
        begin = candles.agg(F.to_date(F.min("open_time"))).scalar()
        span = span.withColumn("first", F.coalesce("first", begin))
    yesterday = F.date_sub(F.lit(as_of).cast("timestamp").cast("date"), 1)
    due = span.filter(F.col("first") <= yesterday).select(
        "symbol", F.explode(F.sequence("first", yesterday)).alias("day")
    )
    return due.join(days, ["symbol", "day"], "left_anti")


def candle_gaps(candles: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Holes inside each series: first missing open time, end, and the candles missing."""
    step = interval_seconds(F.col("interval"))
    found = over_series(
        candles.select(*SILVER_KEYS, "open_time"), SILVER_KEYS, "open_time", step, 1,
        lambda w: {"last_time": F.lag("open_time").over(w)}, rows=rows,
    )
    missing = F.floor((F.unix_seconds("open_time") - F.unix_seconds("last_time")) / step) - 1
    return found.withColumn("missing", missing).filter(F.col("missing") > 0).select(
        *SILVER_KEYS,
        F.timestamp_seconds(F.unix_seconds("last_time") + step).alias("gap_start"),
        F.col("open_time").alias("gap_end"),
        "missing",
    )


def backfill_ranges(gaps: DataFrame, interval: str = "1m", limit: int = REQUEST_ROWS) -> DataFrame:
    """Split each gap into requests of at most ``limit`` intervals."""
    width = interval_seconds(F.lit(interval)) * limit
    start, end = F.unix_seconds("gap_start"), F.unix_seconds("gap_end")
    starts = F.sequence(start, F.greatest(end - 1, start), width)
    requests = gaps.filter(start < end).withColumn("_from", F.explode(starts))
    return requests.select(
        "symbol",
        F.timestamp_seconds("_from").alias("request_start"),
        F.least(F.timestamp_seconds(F.col("_from") + width), F.col("gap_end")).alias("request_end"),
    )
