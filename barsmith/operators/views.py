"""Reader-facing reports over bars and alert events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    local_time, macd_advice, momentum, rsi_advice, rsi_note, trend, volume_surge,
)
from ..vocabulary import RECENT_ALERTS, SERIES_ROWS
from .resample import GOLD_KEYS


def gold_series(
    bars: DataFrame, symbol: str, timeframe: str, limit: int = SERIES_ROWS
) -> DataFrame:
    """The last bars of one series in ascending order, with display time."""
    chosen = bars.filter((F.col("symbol") == symbol) & (F.col("timeframe") == timeframe))
    last = chosen.orderBy(F.col("window_start").desc()).limit(limit)
    return last.withColumn("local_start", local_time(F.col("window_start"))).orderBy("window_start")


def recent_alerts(events: DataFrame, limit: int = RECENT_ALERTS) -> DataFrame:
    """The last alert events of all rules, with display time."""
    newest = events.orderBy(F.col("triggered_at").desc(), F.col("alert_id").desc()).limit(limit)
    return newest.withColumn("local_triggered_at", local_time(F.col("triggered_at")))


def latest_bar_change(bars: DataFrame) -> DataFrame:
    """Each series' last bar and its change from the bar before; a lone bar shows 0.

    Only the last two bars of a series leave each task.
    """
    newest = Window.partitionBy(*GOLD_KEYS).orderBy(F.col("window_start").desc())
    two = (
        bars.select(*GOLD_KEYS, "window_start", "close")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= 2)
    )
    pair = two.groupBy(*GOLD_KEYS).agg(
        F.max("window_start").alias("window_start"),
        F.max_by("close", "window_start").alias("close"),
        F.min_by("close", "window_start").alias("prev_close"),
    )
    change = F.try_divide(F.col("close") - F.col("prev_close"), F.col("prev_close")) * 100
    return pair.withColumn("change_pct", change)


def with_advice(bars: DataFrame) -> DataFrame:
    return bars.withColumns({
        "rsi_advice": rsi_advice(F.col("rsi_14")),
        "rsi_note": rsi_note(F.col("rsi_14")),
        "macd_advice": macd_advice(F.col("macd"), F.col("macd_signal")),
        "volume_advice": volume_surge(F.col("volume_ratio")),
        "momentum": momentum(F.col("macd")),
        "trend": trend(F.col("close"), F.col("ma25")),
    })
