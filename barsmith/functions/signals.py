"""Signal strength and the JSON message of an alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signal_strength(rsi: Column, macd: Column, volume_ratio: Column) -> Column:
    """STRONG, MODERATE or WEAK from a score; unknown inputs add nothing."""
    score = (
        F.when((rsi < 30) | (rsi > 70), 2).when((rsi < 40) | (rsi > 60), 1).otherwise(0)
        + F.when(F.abs(macd) > 0.001, 1).otherwise(0)
        + F.when(volume_ratio > 1.5, 1).otherwise(0)
    )
    return F.when(score >= 3, "STRONG").when(score >= 2, "MODERATE").otherwise("WEAK")


def signal_message(
    symbol: Column, action: Column, close: Column, rsi: Column, macd: Column,
    volume_ratio: Column, pattern: Column, rule_id: Column,
) -> Column:
    """The alert as JSON with NULL members kept; NULL without a symbol or an action."""
    body = F.to_json(
        F.struct(
            symbol.alias("symbol"),
            action.alias("action"),
            F.round(close, 4).alias("close_price"),
            F.round(rsi, 2).alias("rsi_14"),
            F.round(macd, 4).alias("macd"),
            F.round(volume_ratio, 2).alias("volume_ratio"),
            pattern.alias("candle_pattern"),
            rule_id.alias("rule_id"),
            signal_strength(rsi, macd, volume_ratio).alias("signal_type"),
        ),
        {"ignoreNullFields": "false"},
    )
    return F.when((F.length(symbol) > 0) & (F.length(action) > 0), body)
