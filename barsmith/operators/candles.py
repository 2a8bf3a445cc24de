"""Bronze validity, silver cleaning and deduplication of candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket_start, candle_pattern
from .indicators import SILVER_FAMILIES, add_indicators
from .series import SEGMENT_ROWS

CANDLE_KEY = ("symbol", "interval", "open_time")
NUMERIC_COLUMNS = (
    "open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base_vol",
)
SILVER_COLUMNS = (
    "symbol", "open_time", "close_time", "interval", "open", "high", "low", "close", "volume",
    "quote_volume", "trade_count", "taker_buy_base_vol", "partition_date", "ingest_time",
)


def ticks_to_candles(
    ticks: DataFrame, interval: str = "1m", seconds: int = 60, order: str = "trade_time"
) -> DataFrame:
    """Aggregate trades to candles. All buffers are fixed-width, so the hash aggregate
    combines on the map side and a busy minute costs one row per task in the shuffle.

    Open and close go by ``order``, which should be unique among a symbol's trades.
    """
    at, value = F.col("trade_time"), F.col("price") * F.col("quantity")
    taker = ~F.col("is_buyer_maker")
    candles = ticks.groupBy("symbol", bucket_start(at, seconds).alias("open_time")).agg(
        F.max(at).alias("event_time"),
        F.max("ingest_time").alias("ingest_time"),
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
        F.sum(value).alias("quote_volume"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
        F.sum(F.when(taker, F.col("quantity")).otherwise(0.0)).alias("taker_buy_base_vol"),
        F.sum(F.when(taker, value).otherwise(0.0)).alias("taker_buy_quote_vol"),
    )
    last_milli = F.make_dt_interval(secs=F.lit(seconds - 0.001).cast("decimal(18,6)"))
    return candles.select(
        "symbol", "event_time", "ingest_time", "open_time",
        (F.col("open_time") + last_milli).alias("close_time"),
        F.lit(interval).alias("interval"),
        "open", "high", "low", "close", "volume", "quote_volume", "trade_count",
        "taker_buy_base_vol", "taker_buy_quote_vol",
        F.lit(True).alias("is_closed"),
        F.lit("ticks").alias("source"),
        F.to_date("open_time").alias("partition_date"),
    )


def valid_candles(parsed: DataFrame) -> DataFrame:
    """Keep candles with symbol, open time and a numeric close; fill the partition date."""
    close = F.col("close").try_cast("double")
    return parsed.filter(
        F.col("symbol").isNotNull() & F.col("open_time").isNotNull() & close.isNotNull()
    ).withColumn("partition_date", F.coalesce("partition_date", F.to_date("open_time")))


def latest_versions(candles: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """One row per key: closed candles before open ones, then the latest event and arrival.

    The row-number limit also runs before the shuffle, so many copies of one candle leave
    each task as a single row.
    """
    newest = Window.partitionBy(*key).orderBy(
        F.col("is_closed").desc_nulls_last(),
        F.col("event_time").desc_nulls_last(),
        F.col("ingest_time").desc_nulls_last(),
        F.col("source").asc_nulls_last(),
        F.col("trade_count").desc_nulls_last(),
        F.col("volume").desc_nulls_last(),
        F.col("close").desc_nulls_last(),
    )
    ranked = candles.withColumn("_version", F.row_number().over(newest))
    return ranked.filter(F.col("_version") == 1).drop("_version")


def sane(candles: DataFrame) -> DataFrame:
    """Rows with a symbol, a time, a positive close, a volume and a high not below the low."""
    close, volume, high, low = (
        F.col(c).try_cast("double") for c in ("close", "volume", "high", "low")
    )
    return candles.filter(
        F.col("symbol").isNotNull() & F.col("open_time").isNotNull()
        & (close > 0) & (volume >= 0) & (high >= low)
    )


def current(candles: DataFrame) -> DataFrame:
    """Clean candles, one per key. Rows that are not sane do not displace earlier ones."""
    return clean(latest_versions(sane(candles)))


def clean(candles: DataFrame) -> DataFrame:
    """Project to the silver columns and keep sane rows."""
    if "close_time" not in candles.columns and "event_time" in candles.columns:
        candles = candles.withColumnRenamed("event_time", "close_time")
    present = [c for c in SILVER_COLUMNS if c in candles.columns]
    numbers = {c: F.col(c).try_cast("double") for c in NUMERIC_COLUMNS if c in present}
    return sane(candles.select(*present)).withColumns(
        {**numbers, "partition_date": F.to_date("open_time")}
    )


def with_pattern(candles: DataFrame) -> DataFrame:
    return candles.withColumn(
        "candle_pattern",
        candle_pattern(F.col("open"), F.col("high"), F.col("low"), F.col("close")),
    )


def enrich(
    candles: DataFrame, processed_at=None, families=SILVER_FAMILIES, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Silver rows: indicators, pattern and the processing time (now unless given)."""
    stamped = with_pattern(add_indicators(candles, families, rows))
    at = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return stamped.withColumn("processing_time", at.cast("timestamp"))
