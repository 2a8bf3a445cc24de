"""Technical indicators over ordered candles.

Each family is a list of stages for ``over_series``; families merge stage by stage, so any
set of them is computed in the same pass. Frames are in rows, and short frames at the start
of a series still yield values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions import interval_seconds, true_range
from .series import SEGMENT_ROWS, exponential_means, over_series, positions

SILVER_KEYS = ("symbol", "interval")
# The longest silver frame: 99 rows for ma99.
SILVER_CONTEXT = 98


def _mean(window: WindowSpec, column: str, rows: int) -> Column:
    return F.avg(column).over(window.rowsBetween(1 - rows, 0))


def _ratio(part: Column, whole: Column) -> Column:
    """NULL where the divisor is NULL or 0."""
    return F.try_divide(part, whole)


def _sum(window: WindowSpec, column: str, rows: int) -> Column:
    return F.sum(column).over(window.rowsBetween(1 - rows, 0))


def _mean_of_blocks(window: WindowSpec, sums: str, block: int, blocks: int) -> Column:
    """Mean over ``block * blocks`` rows from the rolling sums of ``block`` rows.

    Spark evaluates a sliding frame anew for every row, so a frame of 99 rows costs 99
    updates per row. Eleven sums of nine rows, fetched by lag, give the same mean for a fifth
    of that, and only add like-sized numbers. Rows before the series count as absent.
    """
    total = F.col(sums)
    for i in range(1, blocks):
        total = total + F.coalesce(F.lag(sums, i * block).over(window), F.lit(0.0))
    return total / F.least(F.row_number().over(window), F.lit(block * blocks))


def moving_averages():
    def sums(w):
        return {
            "ma7": _mean(w, "close", 7), "_sum5": _sum(w, "close", 5), "_sum9": _sum(w, "close", 9),
        }

    def means(w):
        return {
            "ma25": _mean_of_blocks(w, "_sum5", 5, 5), "ma99": _mean_of_blocks(w, "_sum9", 9, 11),
        }

    return [sums, means]


def bollinger_bands():
    def middle(w):
        return {
            "bb_middle": _mean(w, "close", 20),
            "_std20": F.stddev_samp("close").over(w.rowsBetween(-19, 0)),
        }

    def bands(w):
        return {
            "bb_upper": F.col("bb_middle") + F.col("_std20") * 2,
            "bb_lower": F.col("bb_middle") - F.col("_std20") * 2,
        }

    return [middle, bands]


def price_change():
    def change(w):
        previous = F.col("prev_close")
        return {"price_change_pct": _ratio(F.col("close") - previous, previous) * 100}

    return [lambda w: {"prev_close": F.lag("close").over(w)}, change]


def atr_14():
    return [
        lambda w: {"prev_close": F.lag("close").over(w)},
        lambda w: {"_true_range": true_range(F.col("high"), F.col("low"), F.col("prev_close"))},
        lambda w: {"atr_14": _mean(w, "_true_range", 14)},
    ]


def rsi_14():
    """Simple-mean form: a first row counts as no move, and no losses give 100."""

    def moves(w):
        delta = F.coalesce(F.col("close") - F.col("prev_close"), F.lit(0.0))
        return {"_gain": F.greatest(delta, F.lit(0.0)), "_loss": F.greatest(-delta, F.lit(0.0))}

    def means(w):
        return {"_mean_gain": _mean(w, "_gain", 14), "_mean_loss": _mean(w, "_loss", 14)}

    def strength(w):
        gain, loss = F.col("_mean_gain"), F.col("_mean_loss")
        return {"rsi_14": F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + gain / loss))}

    return [lambda w: {"prev_close": F.lag("close").over(w)}, moves, means, strength]


def macd_sma():
    return [
        lambda w: {"_sma12": _mean(w, "close", 12), "_sum13": _sum(w, "close", 13)},
        lambda w: {"macd": F.col("_sma12") - _mean_of_blocks(w, "_sum13", 13, 2)},
        lambda w: {"macd_signal": _mean(w, "macd", 9)},
        lambda w: {"macd_hist": F.col("macd") - F.col("macd_signal")},
    ]


def volume_ratio():
    return [
        lambda w: {"avg_volume_20": _mean(w, "volume", 20)},
        lambda w: {"volume_ratio": _ratio(F.col("volume"), F.col("avg_volume_20"))},
    ]


SILVER_FAMILIES = (
    moving_averages, bollinger_bands, price_change, atr_14, rsi_14, macd_sma, volume_ratio,
)


def _merged(families) -> list:
    """Stage i of the result computes stage i of every family."""
    parts = [family() for family in families]
    depth = max(len(stages) for stages in parts)

    def level(i: int):
        def stage(w):
            columns: dict[str, Column] = {}
            for stages in parts:
                if i < len(stages):
                    columns.update(stages[i](w))
            return columns

        return stage

    return [level(i) for i in range(depth)]


def add_indicators(
    candles: DataFrame, families: Sequence = SILVER_FAMILIES, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Add the families' columns to clean, unique candles."""
    return over_series(
        candles, SILVER_KEYS, "open_time", interval_seconds(F.col("interval")), SILVER_CONTEXT,
        *_merged(families), rows=rows,
    )


# ---- exponential forms -------------------------------------------------------------------


def _numbered_closes(candles: DataFrame, rows: int) -> DataFrame:
    step = interval_seconds(F.col("interval"))
    series = candles.select(*SILVER_KEYS, "open_time", "close")
    return positions(series, SILVER_KEYS, "open_time", step, "_position", rows)


def macd_ema(candles: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """MACD with exponential means of 12 and 26 rows and a signal of 9."""
    close = F.col("close")
    lines = exponential_means(
        _numbered_closes(candles, rows), SILVER_KEYS, "_position",
        {"ema12": (close, 2 / 13), "ema26": (close, 2 / 27)},
    ).withColumn("macd", F.col("ema12") - F.col("ema26"))
    signal = exponential_means(
        lines, SILVER_KEYS, "_position", {"macd_signal": (F.col("macd"), 2 / 10)}
    )
    return signal.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop("_position")


def rsi_14_wilder(candles: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Wilder's RSI: NULL before 14 moves and where there was no loss at all."""
    step = interval_seconds(F.col("interval"))
    moves = over_series(
        candles.select(*SILVER_KEYS, "open_time", "close"), SILVER_KEYS, "open_time", step, 1,
        lambda w: {"delta": F.col("close") - F.lag("close").over(w)}, rows=rows,
    )
    # The first row has no move and takes no part in the means.
    numbered = positions(
        moves.filter(F.col("delta").isNotNull()), SILVER_KEYS, "open_time", step, "_position", rows
    )
    delta, zero = F.col("delta"), F.lit(0.0)
    means = exponential_means(
        numbered, SILVER_KEYS, "_position",
        {"gain": (F.greatest(delta, zero), 1 / 14), "loss": (F.greatest(-delta, zero), 1 / 14)},
    )
    strength = 100 - 100 / (1 + F.try_divide(F.col("gain"), F.col("loss")))
    rsi = F.when(F.col("_position") >= 13, strength)
    early = moves.filter(F.col("delta").isNull())
    return (
        means.withColumn("rsi_14_wilder", rsi)
        .unionByName(early, allowMissingColumns=True)
        .select(*SILVER_KEYS, "open_time", "close", "rsi_14_wilder")
    )
