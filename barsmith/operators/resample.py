"""Bars of several timeframes from one base interval, and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bucket_start, interval_seconds
from ..vocabulary import (
    BAR_TIMEFRAMES, CANDLE_PATTERNS, INTERVAL_SECONDS, NUMERIC_FIELDS, SYMBOL_INFO,
    SYMBOL_INFO_DDL,
)
from .series import SEGMENT_ROWS, over_series, running_sum

GOLD_KEYS = ("symbol", "timeframe")
GOLD_KEY = ("symbol", "timeframe", "window_start")
# vwap sums the current bar and the 20 before it.
GOLD_CONTEXT = 20
# Symbols of one bar that a task ranks; a bar with more is ranked in ranges of volume.
RANK_ROWS = 200_000

# Indicator columns a bar takes from its last candle that has a value.
CARRIED = (
    "ma7", "ma25", "ma99", "rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper",
    "bb_lower", "atr_14", "price_change_pct",
)


def _sizes(timeframes: Sequence[str]):
    return F.array(*[
        F.struct(F.lit(name).alias("timeframe"), F.lit(INTERVAL_SECONDS[name]).alias("seconds"))
        for name in timeframes
    ])


def _nests(timeframes: Sequence[str]) -> bool:
    """Whether the finest timeframe's bars make up those of all others, and the coarsest holds all."""
    sizes = sorted(INTERVAL_SECONDS[t] for t in timeframes)
    return len(sizes) > 1 and all(s % sizes[0] == 0 and sizes[-1] % s == 0 for s in sizes)


def _partial(silver: DataFrame, carried: Sequence[str], timeframes: Sequence[str]) -> DataFrame:
    """Candles folded to the finest timeframe, and when each value that is carried was known.

    The rows are dealt out by the coarsest timeframe's bars, which hold whole bars of all others:
    both folds then run where the rows are.
    """
    by_size = sorted(timeframes, key=INTERVAL_SECONDS.__getitem__)
    fine, coarse = (F.lit(INTERVAL_SECONDS[t]) for t in (by_size[0], by_size[-1]))
    at = F.col("open_time")

    def known(c: str):
        return F.when(F.col(c).isNotNull(), at)

    return (
        silver.withColumn("_coarse", bucket_start(at, coarse))
        .repartition("symbol", "_coarse")
        .groupBy("symbol", "_coarse", bucket_start(at, fine).alias("open_time"))
        .agg(
            F.min_by("open", known("open")).alias("open"),
            F.min(known("open")).alias("_at_open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
            *[F.max_by(c, known(c)).alias(c) for c in ("close", *carried)],
            *[F.max(known(c)).alias(f"_at_{c}") for c in ("close", *carried)],
        )
    )


def resample(
    silver: DataFrame, timeframes: Sequence[str] = BAR_TIMEFRAMES, base_interval: str = "1m"
) -> DataFrame:
    """Aggregate candles of one base interval into bars of every timeframe in one shuffle.

    Candles are folded to the finest timeframe first, and its bars to the others. Both folds run
    on one dealing of the candles by symbol and bar of the coarsest timeframe. Timeframes that
    do not nest get a copy of each candle for every one of them, folded before the exchange.
    The pattern travels as a number, because a text buffer would turn the hash aggregate into
    a sort.
    """
    carried = [c for c in CARRIED if c in silver.columns]
    has_pattern = "candle_pattern" in silver.columns
    names = F.array(*[F.lit(p) for p in CANDLE_PATTERNS])
    code = F.array_position(names, F.col("candle_pattern")).cast("int")
    rows = silver
    if "interval" in silver.columns:
        rows = rows.filter(F.col("interval") == base_interval)
    rows = rows.select(
        "symbol", "open_time", "open", "high", "low", "close", "volume", "quote_volume",
        "trade_count", *carried, *([code.alias("_pattern")] if has_pattern else []),
    )
    lasts = [*carried, *(["_pattern"] if has_pattern else [])]
    keys = ["symbol", "timeframe", "_seconds"]
    if _nests(timeframes):
        rows = _partial(rows, lasts, timeframes)
        keys.append("_coarse")
        times = {c: F.col(f"_at_{c}") for c in ("open", "close", *lasts)}
    else:
        times = {c: F.when(F.col(c).isNotNull(), F.col("open_time")) for c in ("open", "close", *lasts)}
    rows = rows.withColumn("_size", F.explode(_sizes(timeframes))).withColumns({
        "timeframe": F.col("_size.timeframe"),
        "_seconds": F.col("_size.seconds"),
    }).drop("_size")
    bars = rows.groupBy(
        *keys, bucket_start(F.col("open_time"), F.col("_seconds")).alias("window_start"),
    ).agg(
        F.min_by("open", times["open"]).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
        *[F.max_by(c, times[c]).alias(c) for c in ("close", *lasts)],
    )
    return bars.select(
        "symbol", "timeframe", "window_start",
        F.timestamp_seconds(F.unix_seconds("window_start") + F.col("_seconds")).alias("window_end"),
        "open", "high", "low", "close", "volume", "quote_volume", "trade_count", *carried,
        *([F.get(names, F.col("_pattern") - 1).alias("candle_pattern")] if has_pattern else []),
    )


def _vwap(w):
    frame = w.rowsBetween(-GOLD_CONTEXT, 0)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return {
        "vwap": F.try_divide(
            F.sum(typical * F.col("volume")).over(frame), F.sum("volume").over(frame)
        )
    }


def _volume_ratio(w):
    mean = F.avg("volume").over(w.rowsBetween(-19, 0))
    return {"volume_ratio": F.try_divide(F.col("volume"), mean)}


def over_bars(bars: DataFrame, before: int, *stages, rows: int = SEGMENT_ROWS) -> DataFrame:
    step = interval_seconds(F.col("timeframe"))
    return over_series(bars, GOLD_KEYS, "window_start", step, before, *stages, rows=rows)


def add_vwap(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    return over_bars(bars, GOLD_CONTEXT, _vwap, rows=rows)


def add_volume_ratio(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    return over_bars(bars, 19, _volume_ratio, rows=rows)


def add_bar_windows(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """VWAP and volume ratio in one pass."""
    return over_bars(bars, GOLD_CONTEXT, lambda w: {**_vwap(w), **_volume_ratio(w)}, rows=rows)


def _previous(columns):
    fields = [f for f in NUMERIC_FIELDS if f in columns]
    return lambda w: {f"prev_{f}": F.lag(f).over(w) for f in fields}


def add_previous(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """The previous bar's value of every numeric rule field, as ``prev_<field>``."""
    return over_bars(bars, 1, _previous(bars.columns), rows=rows)


def add_rule_fields(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """VWAP, volume ratio and all previous values in one pass, for rule evaluation."""
    fields = [*bars.columns, "vwap", "volume_ratio"]
    return over_bars(
        bars, GOLD_CONTEXT + 1, lambda w: {**_vwap(w), **_volume_ratio(w)}, _previous(fields),
        rows=rows,
    )


def _volume_place():
    """A finite volume on a scale where neither small nor large ones crowd; order is kept."""
    volume = F.col("volume").cast("double")
    finite = volume.isNotNull() & ~F.isnan(volume) & (F.abs(volume) < F.lit(float("inf")))
    return F.when(finite, F.signum(volume) * F.log1p(F.abs(volume)))


def _rank_in_bar(bars: DataFrame, name: str, dense: bool, split_rows: int) -> DataFrame:
    """Rank by falling volume among the rows of a bar, without a whole bar in one task.

    A bar of more than ``split_rows`` rows is cut into ranges of volume. A row's rank is its rank
    within its range plus the rows (dense: the different volumes) of the ranges above. Equal
    volumes share a range, so ties stay ties; NaN ranks first and NULL last, as in a plain window.
    """
    bar = ("timeframe", "window_start")
    place = _volume_place()
    large = bars.groupBy(*bar).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(place).alias("_low"), F.max(place).alias("_high"),
    ).filter(F.col("_rows") > split_rows)
    # Several ranges for each split_rows, as volumes are not even on the scale either.
    parts = F.ceil(F.col("_rows") / F.lit(split_rows)) * 8
    share = F.try_divide(place - F.col("_low"), F.col("_high") - F.col("_low"))
    cut = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * parts), parts - 1)
    outside = F.when(F.col("volume").isNull(), F.lit(-2)).when(
        F.col("volume").cast("double") == float("-inf"), F.lit(-1)
    ).otherwise(parts)
    part = F.when(F.col("_rows").isNull(), F.lit(0)).when(place.isNull(), outside).otherwise(cut)
    cut_up = bars.join(large, list(bar), "left").withColumn("_part", part.cast("long"))

    number = F.dense_rank() if dense else F.rank()
    within = Window.partitionBy(*bar, "_part").orderBy(F.col("volume").desc())
    ranked = cut_up.withColumn("_rank", number.over(within))
    counted = F.count_distinct("volume") if dense else F.count(F.lit(1))
    # A NULL volume is the lowest range, so that distinct counts skip it harms no rank.
    above = Window.partitionBy(*bar).orderBy(F.col("_part").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    before = cut_up.filter(F.col("_rows").isNotNull()).groupBy(*bar, "_part").agg(
        counted.alias("_n")
    ).select(*bar, "_part", F.sum("_n").over(above).alias("_above"))
    return ranked.join(before, [*bar, "_part"], "left").select(
        *(F.col(f"`{c}`") for c in bars.columns),
        (F.col("_rank") + F.coalesce("_above", F.lit(0))).cast("int").alias(name),
    )


def add_price_rank(bars: DataFrame, split_rows: int = RANK_ROWS) -> DataFrame:
    """Rank of the symbol by volume among the symbols of the same bar."""
    return _rank_in_bar(bars, "price_rank", False, split_rows)


def add_volume_dense_rank(bars: DataFrame, split_rows: int = RANK_ROWS) -> DataFrame:
    return _rank_in_bar(bars, "volume_dense_rank", True, split_rows)


def add_cumulative_volume(bars: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    step = interval_seconds(F.col("timeframe"))
    return running_sum(
        bars, GOLD_KEYS, "window_start", step, "volume", "cumulative_volume", rows
    )


def symbol_info(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SYMBOL_INFO), SYMBOL_INFO_DDL)


def add_symbol_info(bars: DataFrame, info: DataFrame) -> DataFrame:
    """Left join to the symbol dimension; unknown symbols keep NULLs.

    No hint: Spark broadcasts the dimension when its size is below the session's threshold
    and shuffles otherwise.
    """
    extra = [c for c in info.columns if c != "symbol" and c in bars.columns]
    return bars.drop(*extra).join(info, "symbol", "left")


def gold(
    silver: DataFrame, info: DataFrame | None = None, aggregated_at=None,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Bars of all timeframes with VWAP, volume ratio, date, metadata and a time stamp."""
    bars = add_bar_windows(resample(silver), rows)
    return finish_bars(bars, info, aggregated_at)


def finish_bars(bars: DataFrame, info: DataFrame | None, aggregated_at=None) -> DataFrame:
    at = F.current_timestamp() if aggregated_at is None else F.lit(aggregated_at)
    stamped = bars.withColumns({
        "partition_date": F.to_date("window_start"),
        "aggregated_at": at.cast("timestamp"),
    })
    return stamped if info is None else add_symbol_info(stamped, info)


def pivot_closes(bars: DataFrame, symbols: Sequence[str] | None = None, value: str = "close") -> DataFrame:
    """A row per bar and a column per symbol.

    Naming the symbols leaves out others and spares a job that lists them; without, all have a column.
    """
    rows = bars.groupBy("timeframe", "window_start")
    wide = rows.pivot("symbol") if symbols is None else rows.pivot("symbol", list(symbols))
    return wide.agg(F.max(value))


def unpivot_metrics(
    bars: DataFrame, metrics: Sequence[str] = ("close", "volume", "rsi_14", "macd", "vwap")
) -> DataFrame:
    """A row per bar and metric."""
    present = [m for m in metrics if m in bars.columns]
    return bars.unpivot([*GOLD_KEY], present, "metric_name", "metric_value")
