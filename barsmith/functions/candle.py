"""Functions of a single candle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any_null(*columns: Column) -> Column:
    return reduce(lambda seen, c: seen | c.isNull(), columns, F.lit(False))


def candle_pattern(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """Name the candle's shape; the first matching rule wins, NULL input gives NULL."""
    body = F.abs(close - open_)
    span = F.when(high == low, F.lit(1e-9)).otherwise(high - low)
    upper = high - F.greatest(open_, close)
    lower = F.least(open_, close) - low
    rises = close > open_
    return (
        F.when(_any_null(open_, high, low, close) | (open_ == 0), F.lit(None).cast("string"))
        .when((lower >= body * 2) & (upper <= lower * 0.5) & rises, "HAMMER")
        .when((upper >= body * 2) & (lower <= upper * 0.5) & (close < open_), "SHOOTING_STAR")
        .when(body / span < 0.05, "DOJI")
        .when(body / span <= 0.8, "NEUTRAL")
        .when(rises, "BULLISH")
        .otherwise("BEARISH")
    )


def true_range(high: Column, low: Column, prev_close: Column) -> Column:
    """Largest of the three ranges; ``greatest`` skips the two a first row lacks."""
    return F.greatest(high - low, F.abs(high - prev_close), F.abs(low - prev_close))


def pivot_levels(high: Column, low: Column, close: Column) -> Column:
    """Classic pivot with two resistances and two supports, NULL on NULL input."""
    pivot = (high + low + close) / 3
    span = high - low
    levels = {
        "pivot": pivot,
        "r1": pivot * 2 - low,
        "r2": pivot + span,
        "s1": pivot * 2 - high,
        "s2": pivot - span,
    }
    rounded = F.struct(*[F.round(value, 4).alias(name) for name, value in levels.items()])
    return F.when(~_any_null(high, low, close), rounded)


def volume_profile(high: Column, low: Column, volume: Column, bins: int = 10) -> Column:
    """Spread the volume evenly over equal price steps; NULL for a flat candle."""
    step = (high - low) / bins
    profile = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda i: F.struct(
            F.round(low + step * (i + F.lit(0.5)), 4).alias("price_level"),
            F.round(volume / bins, 4).alias("volume"),
        ),
    )
    return F.when(~_any_null(high, low, volume) & (high != low), profile)
