"""Bars kept by the stream's own state, for consumers that need no history tables.

Duplicates and windows are both bounded by the watermark: state is dropped once the watermark
has passed, so it holds open windows only. ``start`` runs the whole as one query: closed candles
of the base interval are deduplicated within the watermark and folded into the windows of every
timeframe. Each timeframe is a branch of its own, as its windows are state of their own; the
branches share one watermark, which the candles' open times move. Candles that come later than
the watermark are left out and counted, see ``late_rows``; the micro-batch pipeline takes them up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import tables
from ..vocabulary import BAR_TIMEFRAMES, INTERVAL_SECONDS, TRIGGER_INTERVAL, WATERMARK_DELAY


def deduplicated(candles: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Closed candles once each, however often they are sent within the watermark."""
    return (
        candles.filter("is_closed")
        .withWatermark("open_time", delay)
        .dropDuplicatesWithinWatermark(["symbol", "interval", "open_time"])
    )


def folded_bars(rows: DataFrame, timeframe: str) -> DataFrame:
    """Bars of one timeframe from candles of one interval, each of them once, with a watermark."""
    at = F.col("open_time")
    bars = (
        rows.groupBy("symbol", F.window("open_time", f"{INTERVAL_SECONDS[timeframe]} seconds").alias("w"))
        .agg(
            F.min_by("open", at).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", at).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
        )
    )
    return bars.select(
        "symbol", F.lit(timeframe).alias("timeframe"),
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "open", "high", "low", "close", "volume", "quote_volume", "trade_count",
    )


def windowed_bars(
    candles: DataFrame, timeframe: str, delay: str = WATERMARK_DELAY, base_interval: str = "1m"
) -> DataFrame:
    """Bars of one timeframe. In append mode a bar appears when its window has closed.

    Only closed candles of the base interval count, each once: other intervals cover the same
    time again, and open versions precede closed ones.
    """
    return folded_bars(deduplicated(candles.filter(F.col("interval") == base_interval), delay), timeframe)


def all_bars(
    candles: DataFrame, timeframes: Sequence[str] = BAR_TIMEFRAMES, delay: str = WATERMARK_DELAY, base_interval: str = "1m"
) -> DataFrame:
    """Bars of every timeframe as one stream."""
    return reduce(DataFrame.unionByName, [windowed_bars(candles, t, delay, base_interval) for t in timeframes])


def start(
    candles: DataFrame, base: str, timeframes: Sequence[str] = BAR_TIMEFRAMES, delay: str = WATERMARK_DELAY,
    base_interval: str = "1m", available_now: bool = False, interval: str = TRIGGER_INTERVAL, name: str = "windows",
) -> StreamingQuery:
    """Append every closed bar to a table below ``base``, until the source is drained or at an interval."""
    writer = (
        all_bars(candles, timeframes, delay, base_interval).writeStream.outputMode("append")
        .format("parquet").option("path", bars_path(base, name))
        .option("checkpointLocation", tables.checkpoint_path(base, name))
        .queryName(name)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def bars_path(base: str, name: str = "windows") -> str:
    return tables.layer_path(base, "gold", f"{name}_bars")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches dropped because the watermark had passed them.

    A late candle counts once in each branch's deduplication.
    """
    return sum(
        operator["numRowsDroppedByWatermark"] for batch in query.recentProgress for operator in batch["stateOperators"])
