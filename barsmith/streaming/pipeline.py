"""The micro-batch pipeline: messages to bronze, silver, gold and alerts.

The stages are the same functions the batch queries use. Every stage writes its batch under
its number and later stages read what was written, so a batch that runs again replaces its
own output, and a lost executor costs at most the stage at hand. Errors are raised: the
stream then retries the batch from its checkpoint, and nothing is skipped.

A batch may revise or precede rows already stored. What it touches is found per key as the
first and last changed time; rows between them, and as many after them as a rolling value looks
back, are recomputed and written, with the rows before them as context. One late candle in an
old series therefore writes a bounded number of rows.
Context comes from a small table of each key's last rows, so a batch does not read history
unless late rows reach back further than that table does.

Bars are a keyed table: a batch replaces the segments that it touches, and readers see one row for
each bar without folding versions. The source is read and parsed once; the batch's numbers of
read, valid and rejected messages are observed where they are written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import bucket_start, interval_seconds
from ..operators import alerts, candles, resample, rules
from ..operators.indicators import SILVER_CONTEXT, SILVER_KEYS, add_indicators
from ..operators.series import SEGMENT_ROWS
from ..session import pin_utc
from ..sources import messages, tables
from ..sources.keyed import KeyedTable, bar_segment, day_segment
from ..vocabulary import (
    BAR_TIMEFRAMES, CANDLE_TOPIC, RECORDS_PER_TRIGGER, TRIGGER_INTERVAL,
)

BRONZE = f"{schemas.CANDLE}, _kafka_key STRING, _kafka_ts TIMESTAMP"
RULE_STATE = "rule_id STRING, last_triggered_at TIMESTAMP, trigger_count BIGINT"
MESSAGE = "key BINARY, value BINARY, timestamp TIMESTAMP"
# Bars carry VWAP over 21 rows, and the previous bar's VWAP for crossings.
BAR_CONTEXT = resample.GOLD_CONTEXT + 1


@dataclass(frozen=True)
class Pipeline:
    """Where the tables are and how the pipeline behaves.

    ``load_rules`` gives the rule table; triggers already raised are added from a table with one
    row for each rule that has fired, which every batch writes anew. Bars before ``started_at`` raise no alerts. ``publish`` receives the alert messages
    of a batch, for example to write them to a topic, and ``serve`` the batch's bars. Bars are
    made of candles of ``base_interval``; candles of other intervals stay in bronze and silver.
    With ``serving`` the bars and the alerts are also kept as keyed tables below ``serving``, apart
    from gold and from the audit of alerts. ``report`` receives the numbers of each batch.
    """

    base: str
    load_rules: Callable[[SparkSession], DataFrame] | None = None
    load_symbols: Callable[[SparkSession], DataFrame] | None = None
    started_at: datetime | None = None
    publish: Callable[[DataFrame, int], None] | None = None
    serve: Callable[[DataFrame, int], None] | None = None
    bronze_layout: tuple[str, ...] = ("partition_date",)
    gold_layout: tuple[str, ...] = ("timeframe", "partition_date")
    segment_rows: int = SEGMENT_ROWS
    base_interval: str = "1m"
    buckets: int = 8
    serving: bool = False
    report: Callable[[dict[str, int]], None] | None = None

    def path(self, layer: str, table: str = "ohlcv") -> str:
        return tables.layer_path(self.base, layer, table)

    # ---- one micro-batch -----------------------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = pin_utc(batch.sparkSession)
        counts = self._write_bronze(batch, batch_id)
        if self.report:
            self.report({"batch_id": batch_id, **counts})
        new = tables.read_batch(spark, self.path("bronze"), batch_id, BRONZE)
        bounds = new.agg(
            F.min(F.to_date("open_time")).alias("first_day"), F.max("_kafka_ts").alias("arrived")
        ).first()
        first_day = bounds["first_day"]
        if first_day is None:
            return
        # The batch's own arrival time is the clock, so a replay repeats its stamps.
        as_of = bounds["arrived"]
        if as_of is None:
            raise ValueError("messages carry no timestamp")
        changes = _ranges(new, SILVER_KEYS, "open_time")
        self._write_silver(spark, changes, first_day, batch_id, as_of)
        # What silver has written anew is what bars must take up.
        changes = _ranges(
            tables.read_batch(spark, self.path("silver"), batch_id, schemas.SILVER), SILVER_KEYS, "open_time")
        bars = self._bars(spark, changes, first_day, batch_id).persist()
        try:
            self._write_gold(spark, bars, batch_id, as_of)
            self._write_alerts(spark, bars, batch_id, as_of)
        finally:
            bars.unpersist()

    def _write_bronze(self, batch: DataFrame, batch_id: int) -> dict[str, int]:
        """Valid candles and rejected messages of the batch, parsed once; returns their numbers."""
        parsed = messages.parsed_candles(batch, with_text=True).persist()
        valid, rejected = Observation(), Observation()
        try:
            good = candles.valid_candles(parsed.drop("_kafka_value"))
            tables.write_batch(
                good.observe(valid, F.count(F.lit(1)).alias("n")), self.path("bronze"), batch_id, self.bronze_layout
            )
            bad = rejected_messages(parsed)
            tables.write_batch(
                bad.observe(rejected, F.count(F.lit(1)).alias("n")), self.path("bronze", "dead_letters"), batch_id
            )
        finally:
            parsed.unpersist()
        n_valid, n_rejected = valid.get["n"], rejected.get["n"]
        return {"read": n_valid + n_rejected, "valid": n_valid, "rejected": n_rejected}

    def _write_silver(self, spark, changes, first_day, batch_id, as_of) -> None:
        stored = tables.read_batches(spark, self.path("bronze"), batch_id + 1, BRONZE)
        touched = from_first(stored, changes, SILVER_KEYS, "open_time", first_day)
        new = cut_after(candles.current(touched), changes, SILVER_KEYS, "open_time", SILVER_CONTEXT)
        columns = new.columns
        older = self._context(
            spark, "silver", changes, SILVER_KEYS, "open_time", SILVER_CONTEXT, batch_id,
            schemas.SILVER,
        )
        rows = new.withColumn("is_new", F.lit(True))
        if older is not None:
            rows = rows.unionByName(older.select(*columns).withColumn("is_new", F.lit(False)))
        enriched = add_indicators(rows, rows=self.segment_rows).filter("is_new").drop("is_new")
        stamped = candles.with_pattern(enriched).withColumn(
            "processing_time", F.lit(as_of).cast("timestamp")
        )
        tables.write_batch(stamped, self.path("silver"), batch_id, self.bronze_layout)
        self._write_tail(
            spark, "silver", SILVER_KEYS, "open_time", SILVER_CONTEXT, batch_id, schemas.SILVER
        )

    def _bars(self, spark, changes, first_day, batch_id) -> DataFrame:
        """Bars of every touched window and of those after it, with their rule fields."""
        base = changes.filter(F.col("interval") == self.base_interval)
        stored = tables.read_batches(spark, self.path("silver"), batch_id + 1, schemas.SILVER)
        # Every timeframe divides a UTC day, so whole days make whole windows.
        days = base.withColumn("_first", F.date_trunc("day", "_first"))
        rows = current_rows(
            from_first(stored, days, SILVER_KEYS, "open_time", first_day),
            (*SILVER_KEYS, "open_time"),
        )
        windows = base.select(
            "symbol", F.explode(F.array(*[F.lit(t) for t in BAR_TIMEFRAMES])).alias("timeframe"),
            "_first", "_last",
        )
        windows = windows.withColumns({
            c: bucket_start(F.col(c), interval_seconds(F.col("timeframe"))) for c in ("_first", "_last")
        })
        bars = resample.resample(rows, base_interval=self.base_interval)
        new = cut_after(
            from_first(bars, windows, resample.GOLD_KEYS, "window_start"), windows, resample.GOLD_KEYS,
            "window_start", BAR_CONTEXT)
        older = self._context(
            spark, "gold", windows, resample.GOLD_KEYS, "window_start", BAR_CONTEXT, batch_id,
            schemas.GOLD,
        )
        tagged = new.withColumn("is_new", F.lit(True))
        if older is not None:
            columns = [c for c in new.columns if c in older.columns]
            tagged = tagged.unionByName(
                older.select(*columns).withColumn("is_new", F.lit(False)),
                allowMissingColumns=True,
            )
        return resample.add_rule_fields(tagged, self.segment_rows).filter("is_new").drop("is_new")

    def _write_gold(self, spark, bars, batch_id, as_of) -> None:
        plain = bars.drop(*[c for c in bars.columns if c.startswith("prev_")])
        info = self.load_symbols(spark) if self.load_symbols else None
        finished = resample.finish_bars(plain, info, as_of)
        tables.write_batch(finished, self.path("gold"), batch_id, self.gold_layout)
        self._write_tail(
            spark, "gold", resample.GOLD_KEYS, "window_start", BAR_CONTEXT, batch_id, schemas.GOLD
        )
        written = tables.read_batch(spark, self.path("gold"), batch_id, schemas.GOLD)
        self.gold_table().apply(written, batch_id)
        if self.serving:
            self.serving_bars().apply(written, batch_id)
        if self.serve:
            self.serve(tables.read_batch(spark, self.path("gold"), batch_id), batch_id)
        # What the batches wrote is folded into the table; the last ones stay for replays.
        tables.keep_last(spark, self.path("gold"), batch_id)

    def _write_alerts(self, spark, bars, batch_id, as_of) -> None:
        if self.load_rules is None:
            return
        path = self.path("gold", "alert_events")
        table = self.load_rules(spark)
        state = self._latest(spark, self._rule_state_path(), batch_id, RULE_STATE)
        if state is not None:
            table = rules.with_trigger_state(table, state)
        fired = alerts.evaluate(alerts.realtime(bars, self.started_at), table, as_of)
        tables.write_batch(fired.select(*schemas.ALERT_COLUMNS), path, batch_id)
        written = tables.read_batch(spark, path, batch_id, schemas.ALERT_EVENT)
        tables.write_batch(rules.trigger_state(written, state), self._rule_state_path(), batch_id)
        tables.keep_last(spark, self._rule_state_path(), batch_id)
        if self.serving:
            self.serving_alerts().apply(written, batch_id)
        if self.publish:
            self.publish(alerts.alert_messages(written), batch_id)

    # ---- keyed tables --------------------------------------------------------------------

    def _bar_table(self, path: str) -> KeyedTable:
        return KeyedTable(path, schemas.GOLD, resample.GOLD_KEY, lambda: bar_segment(self.buckets), tables.GOLD_INSERT_ONLY)

    def gold_table(self) -> KeyedTable:
        """One row for each bar."""
        return self._bar_table(self.path("gold", "bars"))

    def serving_bars(self) -> KeyedTable:
        """The bars as consumers read them, replaced by key."""
        return self._bar_table(self.path("serving", "serving/bars"))

    def serving_alerts(self) -> KeyedTable:
        """The alerts as consumers page through them; the audit beside it is only appended to."""
        return KeyedTable(
            self.path("serving", "serving/alerts"), schemas.ALERT_EVENT, ("alert_id",), lambda: day_segment("triggered_at"))

    # ---- context -------------------------------------------------------------------------

    def _rule_state_path(self) -> str:
        return self.path("state", "state/rules")

    def _tail_path(self, layer: str) -> str:
        return self.path("state", f"state/{layer}_tail")

    @staticmethod
    def _latest(spark, path, batch_id, schema) -> DataFrame | None:
        """The last batch below ``batch_id`` of a table whose every batch is a whole state."""
        last = tables.latest_batch(spark, path, batch_id)
        return None if last is None else tables.read_batch(spark, path, last, schema)

    def _write_tail(self, spark, layer, keys, order, n, batch_id, schema) -> None:
        """Each key's last ``n`` rows after this batch."""
        written = tables.read_batch(spark, self.path(layer), batch_id, schema)
        rows = written.withColumn(tables.BATCH, F.lit(batch_id))
        before = self._tail(spark, layer, batch_id, schema)
        if before is not None:
            rows = rows.unionByName(before.withColumn(tables.BATCH, F.lit(-1)))
        kept = last_rows(current_rows(rows, (*keys, order)), keys, order, n)
        tables.write_batch(kept, self._tail_path(layer), batch_id)
        tables.keep_last(spark, self._tail_path(layer), batch_id)

    def _tail(self, spark, layer, batch_id, schema) -> DataFrame | None:
        return self._latest(spark, self._tail_path(layer), batch_id, schema)

    def _context(
        self, spark, layer, changes, keys, order, n, batch_id, schema
    ) -> DataFrame | None:
        """The last ``n`` rows of each key before its first change."""
        tail = self._tail(spark, layer, batch_id, schema)
        if tail is None:
            return None
        joined = tail.join(changes.drop("_last"), list(keys))
        earlier = F.col(order) < F.col("_first")
        usable = last_rows(joined.filter(earlier), keys, order, n).drop("_first")
        # A full tail that late rows cut into may lack older rows; those keys read history.
        cut = joined.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_kept"), F.count_if(earlier).alias("_usable"),
            F.first("_first").alias("_first"),
        ).filter((F.col("_kept") >= n) & (F.col("_usable") < n)).select(*keys, "_first")
        if cut.isEmpty():
            return usable
        if layer == "gold":
            past = self.gold_table().read(spark, batch_id).join(cut, list(keys)).filter(earlier).drop("_first")
        else:
            stored = tables.read_batches(spark, self.path(layer), batch_id, schema)
            past = current_rows(stored.join(cut, list(keys)).filter(earlier).drop("_first"), (*keys, order))
        deep = last_rows(past, keys, order, n)
        return usable.join(cut.select(*keys), list(keys), "left_anti").unionByName(deep)

    # ---- views ---------------------------------------------------------------------------

    def silver(self, spark: SparkSession) -> DataFrame:
        stored = tables.read_batches(spark, self.path("silver"), schema=schemas.SILVER)
        return current_rows(stored, (*SILVER_KEYS, "open_time"))

    def gold(self, spark: SparkSession) -> DataFrame:
        return self.gold_table().read(spark)

    def alerts(self, spark: SparkSession) -> DataFrame:
        return tables.read_batches(
            spark, self.path("gold", "alert_events"), schema=schemas.ALERT_EVENT
        )


def from_first(
    rows: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, first_day=None
) -> DataFrame:
    """Rows at or after their key's first change; the day bound prunes partitions."""
    if first_day is not None:
        rows = rows.filter(F.col("partition_date") >= F.lit(first_day))
    return (
        rows.join(changes.select(*keys, "_first"), list(keys))
        .filter(F.col(order) >= F.col("_first"))
        .drop("_first")
    )


def _ranges(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))


def cut_after(rows: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """Rows up to their key's last change, and the ``n`` rows that follow it."""
    marked = rows.join(changes.select(*keys, "_last"), list(keys)).withColumn("_after", F.col(order) > F.col("_last"))
    following = Window.partitionBy(*keys, "_after").orderBy(order)
    return (
        marked.withColumn("_rank", F.when(F.col("_after"), F.row_number().over(following)))
        .filter(~F.col("_after") | (F.col("_rank") <= n))
        .drop("_last", "_after", "_rank")
    )


def current_rows(versions: DataFrame, key: Sequence[str]) -> DataFrame:
    """The latest batch's version of each row."""
    newest = Window.partitionBy(*key).orderBy(F.col(tables.BATCH).desc())
    return (
        versions.withColumn("_version", F.row_number().over(newest))
        .filter(F.col("_version") == 1)
        .drop("_version", tables.BATCH)
    )


def last_rows(rows: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """Messages, parsed with their text, that give no valid candle, with the reason."""
    error = (
        F.when(F.get_json_object("_kafka_value", "$").isNull(), "invalid JSON")
        .when(F.col("symbol").isNull(), "no symbol")
        .when(F.col("open_time").isNull(), "no open time")
        .when(F.col("close").isNull(), "no close")
    )
    bad = F.col("symbol").isNull() | F.col("open_time").isNull() | F.col("close").isNull()
    return parsed.filter(bad).select(
        F.col("_kafka_ts").alias("timestamp"), error.alias("error"),
        F.col("_kafka_value").alias("event"),
    )


def kafka_source(
    spark: SparkSession, servers: str, topic: str = CANDLE_TOPIC, fail_on_data_loss: bool = True,
) -> DataFrame:
    """The candle topic from its start, a bounded number of records per trigger.

    Offsets that expired before they were read stop the stream; without ``fail_on_data_loss``
    they are passed over.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .option("maxOffsetsPerTrigger", RECORDS_PER_TRIGGER)
        .load()
    )


def file_source(
    spark: SparkSession, path: str, schema: str = MESSAGE, files_per_trigger: int = 1,
    fmt: str = "parquet",
) -> DataFrame:
    """The same messages from files, a bounded number of files per trigger."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def start(
    source: DataFrame, pipeline: Pipeline, available_now: bool = False,
    interval: str = TRIGGER_INTERVAL, name: str = "medallion",
) -> StreamingQuery:
    """Start the pipeline, either until the source is drained or at a fixed interval."""
    writer = (
        source.writeStream.foreachBatch(pipeline.process)
        .option("checkpointLocation", tables.checkpoint_path(pipeline.base, name))
        .queryName(name)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
