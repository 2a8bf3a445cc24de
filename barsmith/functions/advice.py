"""Reader-facing labels of a bar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rsi_advice(rsi: Column) -> Column:
    return (
        F.when(rsi > 70, "SELL / OVERBOUGHT").when(rsi < 30, "BUY / OVERSOLD").otherwise("NEUTRAL")
    )


def rsi_note(rsi: Column) -> Column:
    return (
        F.when(rsi.isNull(), "Waiting for data...")
        .when(rsi > 70, "Price is likely stretched high.")
        .when(rsi < 30, "Price might be undervalued.")
        .otherwise("Market is in balance.")
    )


def macd_advice(macd: Column, signal: Column) -> Column:
    return (
        F.when(macd.isNull() | signal.isNull(), "NEUTRAL")
        .when(macd > signal, "BULLISH MOMENTUM")
        .otherwise("BEARISH MOMENTUM")
    )


def volume_surge(volume_ratio: Column) -> Column:
    return F.when(volume_ratio > 1.5, "HIGH SURGE").otherwise("NORMAL")


def momentum(macd: Column) -> Column:
    return F.when(macd > 0, "Positive").otherwise("Negative")


def trend(close: Column, ma25: Column) -> Column:
    return F.when(close > F.coalesce(ma25, F.lit(0.0)), "Bullish").otherwise("Bearish")
