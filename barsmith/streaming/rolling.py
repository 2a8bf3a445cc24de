"""Indicators whose look-back the stream keeps itself, for consumers that need no history tables.

The keyed state holds each series' last candles, as many as the longest frame looks back. A batch
gets them as context in front of its own candles, and the indicators are the same window
functions as everywhere else. State is kept in RocksDB, so it may outgrow an executor's memory, and
a series whose newest candle is ``idle`` seconds behind the watermark is forgotten. One task holds the candles of one series
in one batch, which the source's admission bounds, and 98 rows of state.

Closed candles count once each within the watermark. One that comes within the watermark but behind its
series' newest would change values already written: it is stored as late, for the micro-batch
pipeline to take up. Candles without an interval or an open price, and rows that are not
sane, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import candles as candle_rows
from ..operators.indicators import SILVER_CONTEXT, SILVER_KEYS, add_indicators
from ..operators.series import SEGMENT_ROWS
from ..sources import tables
from ..vocabulary import TRIGGER_INTERVAL, WATERMARK_DELAY
from .windows import deduplicated

VALUES = ("open", "high", "low", "close", "volume")
ROWS = "symbol STRING, interval STRING, at BIGINT, " + ", ".join(f"{c} DOUBLE" for c in VALUES) + ", kind STRING"
STATE = "candles BINARY"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IDLE = 7 * 24 * 3600


def _held(state: GroupState) -> pd.DataFrame:
    """The candles in the state: 64 bits of time, then of each value, row by row."""
    kept = bytes(state.get[0]) if state.exists else b""
    table = np.frombuffer(kept, np.float64).reshape(-1, 1 + len(VALUES))
    out = pd.DataFrame(table[:, 1:], columns=list(VALUES))
    out.insert(0, "at", table[:, :1].copy().view(np.int64)[:, 0])
    return out


def _packed(rows: pd.DataFrame) -> bytes:
    at = rows["at"].to_numpy(np.int64).view(np.float64)
    return np.column_stack([at, rows[list(VALUES)].to_numpy(np.float64)]).tobytes()


def with_kept_context(candles: DataFrame, before: int = SILVER_CONTEXT, idle: int = IDLE) -> DataFrame:
    """Each batch's candles as rows of kind ``new`` or ``late``, and the ``context`` of new ones."""

    def carry(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = _held(state)
        came = pd.concat(list(frames))[["at", *VALUES]].sort_values("at")
        behind = came["at"] <= held["at"].max() if len(held) else pd.Series(False, index=came.index)
        late, new = came[behind], came[~behind]
        if len(new):
            state.update((_packed(pd.concat([held, new]).tail(before)),))
        newest = max(int(held["at"].max()) if len(held) else 0, int(came["at"].max())) // 1000
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + idle * 1000)
        parts = [(late, "late"), (new, "new")] + ([(held, "context")] if len(new) else [])
        for part, kind in parts:
            yield part.assign(symbol=key[0], interval=key[1], kind=kind)[["symbol", "interval", "at", *VALUES, "kind"]]

    rows = candles.select(
        *SILVER_KEYS, "open_time", F.unix_micros("open_time").alias("at"), *[F.col(c).cast("double").alias(c) for c in VALUES])
    return rows.groupBy(*SILVER_KEYS).applyInPandasWithState(
        carry, ROWS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def values_path(base: str, name: str = "rolling") -> str:
    return tables.layer_path(base, "silver", f"{name}_values")


def late_path(base: str, name: str = "rolling") -> str:
    return tables.layer_path(base, "silver", f"{name}_late")


def start(
    candles: DataFrame, base: str, delay: str = WATERMARK_DELAY, idle: int = IDLE, rows: int = SEGMENT_ROWS,
    available_now: bool = False, interval: str = TRIGGER_INTERVAL, name: str = "rolling",
) -> StreamingQuery:
    """Write every closed candle's indicators below ``base``, until the source is drained or at an interval.

    Sets the session's state store to RocksDB. A batch that runs again replaces its output.
    """
    context = tables.layer_path(base, "state", f"state/{name}_rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        # Written first, so that the state is advanced by one pass over the batch.
        tables.write_batch(batch, context, batch_id)
        got = tables.read_batch(spark, context, batch_id, ROWS).withColumn("open_time", F.timestamp_micros("at"))
        tables.write_batch(got.filter("kind = 'late'").drop("kind", "at"), late_path(base, name), batch_id)
        tagged = got.filter("kind <> 'late'").withColumn("is_new", F.col("kind") == "new").drop("kind", "at")
        done = add_indicators(tagged, rows=rows).filter("is_new").drop("is_new")
        tables.write_batch(candle_rows.with_pattern(done), values_path(base, name), batch_id)
        tables.keep_last(spark, context, batch_id)

    whole = candle_rows.sane(candles).filter(F.col("interval").isNotNull() & F.col("open").try_cast("double").isNotNull())
    candles.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = (
        with_kept_context(deduplicated(whole, delay), idle=idle).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", tables.checkpoint_path(base, name)).queryName(name)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
