"""One named query per operator, over the test tables through the adapters.

No value depends on when a query runs. How results are shown for the comparison with SQL is the
driver contract's business, see ``__spark_entry__.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import alerts, candles, dispatch, gaps, history, indicators, resample, rules, views
from ..session import pin_utc
from ..sources import adapters, messages, tables
from ..vocabulary import GOLD_HISTORY, INTERVAL_SECONDS, SILVER_HISTORY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF, INGESTED_AT = adapters.AS_OF, adapters.INGESTED_AT


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_utc(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


# ---- shared stages -----------------------------------------------------------------------


def _clean(spark, sf):
    return candles.clean(adapters.candles(spark, sf))


def _silver(spark, sf, *families):
    return indicators.add_indicators(_clean(spark, sf), families or indicators.SILVER_FAMILIES)


def _full_silver(spark, sf):
    return candles.enrich(_clean(spark, sf), AS_OF)


def _bars(spark, sf, timeframes=resample.BAR_TIMEFRAMES):
    return resample.resample(_clean(spark, sf), timeframes)


def _rule_bars(spark, sf):
    return resample.add_rule_fields(resample.resample(_full_silver(spark, sf)))


def _picked(*names):
    return ["symbol", "open_time", *names]


# ---- sources and parsing -----------------------------------------------------------------

CANDLE_FACTS = [
    "symbol", "event_time", "open_time", "close_time", "interval", "open", "high", "low",
    "close", "volume", "quote_volume", "trade_count", "taker_buy_base_vol",
    "taker_buy_quote_vol", "is_closed", "source", "partition_date",
]


@query
def candles_1m(spark, sf):
    return adapters.candles(spark, sf).select(*CANDLE_FACTS)


@query
def bronze_parse_candles(spark, sf):
    feed = messages.candle_messages(adapters.candles(spark, sf))
    stamped = feed.withColumn("timestamp", F.lit(INGESTED_AT))
    return messages.parsed_candles(stamped).select("_kafka_key", "_kafka_ts", *CANDLE_FACTS)


@query
def bronze_valid(spark, sf):
    """Candle messages with broken ones among them, parsed and validated."""
    source = adapters.candles(spark, sf).withColumns({
        "close": F.when(F.col("volume") >= 20, F.col("close")),
        "partition_date": F.when(F.col("symbol") != "view", F.col("partition_date")),
    })
    feed = messages.candle_messages(source).withColumns({
        "timestamp": F.lit(INGESTED_AT),
        "value": F.when(F.col("key") == "signup", F.concat(F.lit("{"), "value"))
        .otherwise(F.col("value")),
    })
    return candles.valid_candles(messages.parsed_candles(feed)).select(
        "symbol", "open_time", "close", "partition_date"
    )


@query
def parse_kline_messages(spark, sf):
    parsed = messages.unwrapped(adapters.kline_messages(spark, sf))
    return messages.kline_candles(parsed, INGESTED_AT).select(*CANDLE_FACTS)


@query
def parse_trade_messages(spark, sf):
    parsed = messages.unwrapped(adapters.trade_messages(spark, sf))
    return messages.trade_ticks(parsed, INGESTED_AT)


@query
def parse_book_messages(spark, sf):
    return messages.book_rows(messages.unwrapped(adapters.book_messages(spark, sf)), INGESTED_AT)


@query
def parse_rest_klines(spark, sf):
    return messages.rest_candles(adapters.rest_rows(spark, sf), ingested_at=INGESTED_AT).select(
        *CANDLE_FACTS
    )


@query
def route_messages(spark, sf):
    routed = messages.routed(adapters.mixed_messages(spark, sf))
    return routed.groupBy("route", "key").agg(F.count(F.lit(1)).alias("messages"))


@query
def symbol_partition(spark, sf):
    """Listed symbols by place, supplier names by hash."""
    listed = adapters.ticks(spark, sf).select("symbol")
    others = adapters.table(spark, sf, "supplier").select(F.col("s_name").alias("symbol"))
    known = adapters.SYMBOLS[:5]
    return listed.unionByName(others).distinct().withColumn(
        "partition", messages.symbol_partition(F.col("symbol"), known)
    )


@query
def book_spread(spark, sf):
    book = messages.book_rows(messages.unwrapped(adapters.book_messages(spark, sf)), INGESTED_AT)
    return messages.with_spread(book).select("update_id", "symbol", "spread")


@query
def supported_symbols(spark, sf):
    listed = adapters.symbol_dimension(spark)
    return messages.supported(adapters.ticks(spark, sf), listed).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("ticks")
    )


@query
def unsupported_symbols(spark, sf):
    return messages.unsupported_symbols(
        adapters.ticks(spark, sf), adapters.symbol_dimension(spark)
    )


@query
def last_seen_per_symbol(spark, sf):
    return gaps.last_seen(adapters.candles(spark, sf))


# ---- silver ------------------------------------------------------------------------------


@query
def silver_dedup(spark, sf):
    latest = candles.latest_versions(adapters.candle_versions(spark, sf))
    return latest.select(*[c for c in CANDLE_FACTS if c != "source"])


@query
def silver_clean(spark, sf):
    """Cleaning of candles among which those of a single trade lack a volume in every seventh minute."""
    minute = F.floor(F.unix_seconds("open_time") / 60)
    source = adapters.candles(spark, sf).withColumn(
        "volume", F.when((F.col("trade_count") > 1) | (minute % 7 != 0), F.col("volume"))
    )
    return candles.clean(source).drop("ingest_time")


@query
def moving_averages(spark, sf):
    return _silver(spark, sf, indicators.moving_averages).select(*_picked("ma7", "ma25", "ma99"))


@query
def bollinger_bands(spark, sf):
    return _silver(spark, sf, indicators.bollinger_bands).select(
        *_picked("bb_middle", "bb_upper", "bb_lower")
    )


@query
def price_change(spark, sf):
    return _silver(spark, sf, indicators.price_change).select(
        *_picked("prev_close", "price_change_pct")
    )


@query
def true_range(spark, sf):
    changed = _silver(spark, sf, indicators.price_change)
    value = fn.true_range(F.col("high"), F.col("low"), F.col("prev_close"))
    return changed.select(*_picked(value.alias("true_range")))


@query
def atr_14(spark, sf):
    return _silver(spark, sf, indicators.atr_14).select(*_picked("atr_14"))


@query
def rsi_14(spark, sf):
    return _silver(spark, sf, indicators.rsi_14).select(*_picked("rsi_14"))


@query
def macd_sma(spark, sf):
    return _silver(spark, sf, indicators.macd_sma).select(
        *_picked("macd", "macd_signal", "macd_hist")
    )


@query
def volume_ratio(spark, sf):
    return _silver(spark, sf, indicators.volume_ratio).select(
        *_picked("avg_volume_20", "volume_ratio")
    )


@query
def candle_pattern(spark, sf):
    return candles.with_pattern(_clean(spark, sf)).select(*_picked("candle_pattern"))


@query
def silver_full(spark, sf):
    """All silver columns in one pass."""
    return _full_silver(spark, sf).drop("ingest_time")


@query
def macd_ema(spark, sf):
    return indicators.macd_ema(_clean(spark, sf)).select(
        *_picked("ema12", "ema26", "macd", "macd_signal")
    )


@query
def rsi_14_wilder(spark, sf):
    return indicators.rsi_14_wilder(_clean(spark, sf)).select(*_picked("rsi_14_wilder"))


@query
def support_resistance(spark, sf):
    levels = fn.pivot_levels(F.col("high"), F.col("low"), F.col("close"))
    return _clean(spark, sf).select(*_picked(levels.alias("levels"))).select(
        *_picked("levels.*")
    )


@query
def volume_profile(spark, sf):
    """Volume per price level, summed over all bars of a symbol and timeframe."""
    profile = fn.volume_profile(F.col("high"), F.col("low"), F.col("volume"))
    spread = _bars(spark, sf).select("symbol", "timeframe", F.explode(profile).alias("step"))
    return spread.groupBy("symbol", "timeframe", F.floor("step.price_level").alias("price")).agg(
        F.count(F.lit(1)).alias("steps"), F.sum("step.volume").alias("volume")
    )


@query
def signal_strength(spark, sf):
    silver = _silver(
        spark, sf, indicators.rsi_14, indicators.macd_sma, indicators.volume_ratio
    ).select("symbol", "open_time", *[F.round(c, 6).alias(c) for c in ("rsi_14", "macd", "volume_ratio")])
    value = fn.signal_strength(F.col("rsi_14"), F.col("macd"), F.col("volume_ratio"))
    return silver.select(*_picked(value.alias("signal_type")))


# ---- history and merging -----------------------------------------------------------------


def _last_day(spark, sf):
    return adapters.events_end(spark, sf) - timedelta(days=1)


def _split_by_day(spark, sf, df, column="open_time"):
    """The last day's rows as a batch, and the whole table."""
    return df.filter(F.col(column) >= F.lit(_last_day(spark, sf))), df


@query
def batch_keys(spark, sf):
    batch, _ = _split_by_day(spark, sf, adapters.candles(spark, sf))
    return history.batch_keys(batch, indicators.SILVER_KEYS)


@query
def history_without_batch(spark, sf):
    batch, table = _split_by_day(spark, sf, adapters.candles(spark, sf))
    return history.history_without_batch(table, batch, candles.CANDLE_KEY).select(
        "symbol", "interval", "open_time", "close"
    )


@query
def latest_n_per_key(spark, sf):
    batch, table = _split_by_day(spark, sf, adapters.candles(spark, sf))
    rows = history.latest_before(table, batch, indicators.SILVER_KEYS, "open_time", SILVER_HISTORY)
    return rows.select("symbol", "interval", "open_time", "close")


@query
def latest_n_bars_per_key(spark, sf):
    batch, table = _split_by_day(spark, sf, _bars(spark, sf), "window_start")
    rows = history.latest_before(table, batch, resample.GOLD_KEYS, "window_start", GOLD_HISTORY)
    return rows.select("symbol", "timeframe", "window_start", "close")


@query
def union_missing_columns(spark, sf):
    new, table = _split_by_day(spark, sf, adapters.candles(spark, sf))
    old = history.history_without_batch(table, new, candles.CANDLE_KEY).drop("quote_volume")
    return history.union_by_name(new, old).select(
        "symbol", "open_time", "close", "quote_volume", "is_new"
    )


@query
def batch_metrics(spark, sf):
    """Rows read, valid and rejected per day."""
    source = adapters.candles(spark, sf)
    good = (F.col("close") > 0) & (F.col("volume") >= 0) & (F.col("high") >= F.col("low"))
    return source.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(good).alias("rows_valid"),
        F.count_if(~good).alias("rows_rejected"),
    )


@query
def gold_upsert(spark, sf):
    """Bars aggregated per ten-hour batch, so that long bars arrive in several versions."""
    rows = _clean(spark, sf)
    step = F.floor(F.unix_seconds("open_time") / 36_000)
    tagged = rows.withColumns({
        "symbol": F.concat_ws("#", "symbol", step.cast("string")),
    })
    parts = resample.resample(tagged)
    name = F.split("symbol", "#")
    versions = parts.withColumns({
        tables.BATCH: F.get(name, F.lit(1)).cast("bigint"), "symbol": F.get(name, F.lit(0)),
    })
    return tables.gold_view(versions).drop("candle_pattern")


# ---- gold --------------------------------------------------------------------------------

BAR_FACTS = [
    "symbol", "timeframe", "window_start", "window_end", "open", "high", "low", "close",
    "volume", "quote_volume", "trade_count",
]


def _resample_query(name: str) -> None:
    def build(spark, sf):
        return _bars(spark, sf, (name,)).select(*BAR_FACTS)

    build.__name__ = f"resample_{name}"
    query(build)


for _name in resample.BAR_TIMEFRAMES:
    _resample_query(_name)


@query
def resample_all(spark, sf):
    """Bars of all timeframes with the indicators of their last candle."""
    return resample.resample(_full_silver(spark, sf))


@query
def vwap(spark, sf):
    return resample.add_vwap(_bars(spark, sf)).select(*resample.GOLD_KEY, "vwap")


@query
def gold_volume_ratio(spark, sf):
    return resample.add_volume_ratio(_bars(spark, sf)).select(*resample.GOLD_KEY, "volume_ratio")


@query
def gold_with_metadata(spark, sf):
    bars = resample.finish_bars(
        resample.add_bar_windows(_bars(spark, sf)), adapters.symbol_dimension(spark), AS_OF
    )
    return bars.select(
        *resample.GOLD_KEY, "close", "vwap", "volume_ratio", "partition_date", "aggregated_at",
        "name", "base_asset", "consensus", "cmc_rank",
    )


@query
def price_rank(spark, sf):
    return resample.add_price_rank(_bars(spark, sf)).select(*resample.GOLD_KEY, "price_rank")


@query
def volume_dense_rank(spark, sf):
    return resample.add_volume_dense_rank(_bars(spark, sf)).select(
        *resample.GOLD_KEY, "volume_dense_rank"
    )


@query
def cumulative_volume(spark, sf):
    return resample.add_cumulative_volume(_bars(spark, sf)).select(
        *resample.GOLD_KEY, "cumulative_volume"
    )


@query
def prev_values(spark, sf):
    bars = resample.resample(_full_silver(spark, sf))
    return resample.add_previous(bars).select(
        *resample.GOLD_KEY, "prev_close", "prev_rsi_14", "prev_macd", "prev_macd_signal"
    )


@query
def pivot_metrics(spark, sf):
    return resample.pivot_closes(_bars(spark, sf), adapters.SYMBOLS[:5])


@query
def unpivot_metrics(spark, sf):
    silver = _silver(spark, sf, indicators.rsi_14)
    return resample.unpivot_metrics(resample.resample(silver), ("close", "volume", "rsi_14"))


@query
def realtime_gate(spark, sf):
    return alerts.realtime(_bars(spark, sf), _last_day(spark, sf)).select(*resample.GOLD_KEY, "close")


@query
def supplier_candles_1d(spark, sf):
    return adapters.supplier_candles(spark, sf).select(
        "symbol", "open_time", "open", "high", "low", "close", "volume", "quote_volume",
        "trade_count", "taker_buy_base_vol",
    )


@query
def supplier_indicators(spark, sf):
    """All indicators over every supplier's daily candles."""
    daily = candles.clean(adapters.supplier_candles(spark, sf))
    return indicators.add_indicators(daily).select(*_picked(
        "ma7", "ma25", "ma99", "bb_upper", "bb_lower", "atr_14", "rsi_14", "macd",
        "macd_signal", "volume_ratio",
    ))


@query
def supplier_metadata(spark, sf):
    daily = adapters.supplier_candles(spark, sf)
    return resample.add_symbol_info(daily, adapters.supplier_info(spark, sf)).groupBy(
        "region", "nation"
    ).agg(
        F.count(F.lit(1)).alias("candles"), F.sum("volume").alias("volume"),
        F.max("high").alias("high"),
    )


# ---- rules -------------------------------------------------------------------------------


def _flat(rules_df):
    """A rule's nested columns as text."""
    condition = F.transform(
        "conditions", lambda c: F.concat_ws(" ", c["field"], c["operator"], c["value"])
    )
    return rules_df.withColumn("conditions", F.array_join(condition, "; "))


@query
def active_rules(spark, sf):
    return _flat(rules.active_rules(adapters.rules(spark, sf)))


@query
def rule_violations(spark, sf):
    return rules.rule_violations(rules.normalised(adapters.rule_payloads(spark, sf)))


@query
def rules_created(spark, sf):
    """Submitted rules added to the table; hashed ids are left to the unit tests."""
    made = rules.created(adapters.rules(spark, sf), adapters.rule_payloads(spark, sf), AS_OF)
    given = F.when(F.length("rule_id") < 64, F.col("rule_id"))
    return _flat(made).select(
        given.alias("rule_id"), "user_id", "symbol", "timeframe", "conditions", "logic", "action",
        F.array_join("notification_channels", ",").alias("channels"),
        "cooldown_seconds", "is_active", "created_at", "trigger_count",
    )


def _patches(spark, sf):
    """Every order of a customer as a patch of their rule, in turn; some of them are not allowed."""
    message = F.col("message")
    urgent, high = message == "1-URGENT", message == "2-HIGH"
    return adapters.alert_events(spark, sf).select(
        "rule_id", "user_id", F.col("triggered_at").alias("patched_at"), "alert_id",
        F.when(message != "5-LOW", F.col("action")).alias("action"),
        F.when(urgent, F.lit(60)).when(message == "3-MEDIUM", F.lit(5)).alias("cooldown_seconds"),
        F.when(urgent, F.lit("OR")).when(message.startswith("4"), F.lit("XOR")).alias("logic"),
        F.when(urgent, F.lit(True)).when(high, F.lit(False)).alias("is_active"),
    )


_RULE_STATE = ["rule_id", "user_id", "action", "cooldown_seconds", "logic", "is_active", "updated_at"]


@query
def rules_patched(spark, sf):
    return rules.patched(
        adapters.rules(spark, sf), _patches(spark, sf), AS_OF, ("patched_at", "alert_id")
    ).select(*_RULE_STATE)


@query
def patch_violations(spark, sf):
    return rules.patch_violations(_patches(spark, sf))


@query
def rules_toggled(spark, sf):
    events = adapters.alert_events(spark, sf).filter("message = '1-URGENT' and action = 'BUY'")
    return rules.toggled(adapters.rules(spark, sf), events, AS_OF).select(*_RULE_STATE)


def _kept_rules(spark, sf):
    gone = adapters.table(spark, sf, "customer").filter("c_mktsegment = 'FURNITURE'").select(
        F.concat(F.lit("rule-"), "c_custkey").alias("rule_id"),
        F.concat(F.lit("user-"), F.pmod(F.col("c_custkey"), F.lit(25))).alias("user_id"),
    )
    return rules.deleted(adapters.rules(spark, sf), gone)


@query
def rules_deleted(spark, sf):
    return _kept_rules(spark, sf).select(*_RULE_STATE)


@query
def rules_page(spark, sf):
    page = rules.rules_page(adapters.rules(spark, sf), "user-7", is_active=True, page=2, limit=10)
    return page.select("rule_id", "user_id", "symbol", "timeframe", "created_at", "total")


@query
def rule_by_id(spark, sf):
    return _flat(rules.rule_by_id(adapters.rules(spark, sf), "rule-57", "user-7")).select(
        "rule_id", "symbol", "timeframe", "conditions", "logic", "action"
    )


@query
def rule_history(spark, sf):
    return rules.rule_history(adapters.alert_events(spark, sf), 5)


@query
def rule_trigger_stats(spark, sf):
    return rules.with_trigger_stats(
        adapters.rules(spark, sf), adapters.alert_events(spark, sf)
    ).select("rule_id", "last_triggered_at", "trigger_count")


# ---- alerts ------------------------------------------------------------------------------


@query
def conditions_evaluated(spark, sf):
    return alerts.condition_counts(
        _rule_bars(spark, sf), rules.active_rules(adapters.rules(spark, sf))
    )


@query
def rules_matched(spark, sf):
    return alerts.match_counts(
        _rule_bars(spark, sf), rules.active_rules(adapters.rules(spark, sf))
    )


def _latest(spark, sf, reasons=False):
    active = rules.active_rules(adapters.rules(spark, sf))
    return alerts.latest_matches(_rule_bars(spark, sf), active, reasons)


@query
def alerts_with_reasons(spark, sf):
    """Outcome of each condition of a match; the value shown is left to the unit tests."""
    reasons = F.transform(
        "conditions_met", lambda r: F.regexp_replace(r, r" \(current=.*", "")
    )
    return _latest(spark, sf, reasons=True).select(
        "rule_id", "symbol", "timeframe", "window_start",
        F.array_join(reasons, "; ").alias("reasons"),
    )


@query
def alerts_after_cooldown(spark, sf):
    return alerts.after_cooldown(_latest(spark, sf), AS_OF).select(
        "rule_id", "symbol", "timeframe", "window_start"
    )


@query
def alerts_triggered(spark, sf):
    fired = alerts.evaluate(_rule_bars(spark, sf), adapters.rules(spark, sf), AS_OF)
    return fired.drop("message")


@query
def format_signal(spark, sf):
    """Members of the message of every alert event."""
    columns = ("symbol", "action", "close_price", "rsi_14", "macd", "volume_ratio",
               "candle_pattern", "rule_id")
    body = fn.signal_message(*[F.col(c) for c in columns])
    made = adapters.alert_events(spark, sf).select("alert_id", body.alias("body"))

    def member(name):
        return F.get_json_object("body", f"$.{name}")

    numbers = ("close_price", "rsi_14", "macd", "volume_ratio")
    texts = ("symbol", "action", "candle_pattern", "rule_id", "signal_type")
    return made.select(
        "alert_id",
        *[member(n).cast("double").alias(n) for n in numbers],
        *[member(n).alias(n) for n in texts],
    )


@query
def alerts_deduped(spark, sf):
    events = adapters.alert_events(spark, sf).withColumn("window_start", F.col("triggered_at"))
    return alerts.one_per_rule(events).select("rule_id", "alert_id", "window_start")


@query
def alert_messages(spark, sf):
    sent = alerts.alert_messages(adapters.alert_events(spark, sf))
    body = F.from_json("value", "alert_id STRING, triggered_at TIMESTAMP, close_price DOUBLE, "
                                "candle_pattern STRING")
    return sent.select("key", body.alias("b")).select("key", "b.*")


@query
def alert_events_valid(spark, sf):
    return dispatch.valid_events(adapters.alert_event_messages(spark, sf))


@query
def alert_dead_letters(spark, sf):
    letters = dispatch.dead_letters(adapters.alert_event_messages(spark, sf), AS_OF)
    number = F.regexp_extract("event", r"alert-(\d+)", 1).cast("bigint")
    return letters.select("timestamp", "error", number.alias("order_number"))


@query
def dispatch_rows(spark, sf):
    sent = dispatch.dispatch_rows(adapters.alert_events(spark, sf), _kept_rules(spark, sf))
    return sent.select("alert_id", "rule_id", "channel", "target", "triggered_at")


@query
def dispatch_rejects(spark, sf):
    return dispatch.dispatch_rejects(adapters.alert_events(spark, sf), _kept_rules(spark, sf)).select(
        "alert_id", "rule_id"
    )


@query
def alert_text(spark, sf):
    return adapters.alert_events(spark, sf).select("alert_id", dispatch.alert_text().alias("text"))


@query
def webhook_payload(spark, sf):
    body = adapters.alert_events(spark, sf).select("alert_id", dispatch.webhook_payload().alias("body"))

    def member(path):
        return F.get_json_object("body", f"$.{path}")

    return body.select(
        "alert_id", member("event_type").alias("event_type"), member("user_id").alias("user_id"),
        member("triggered_at").alias("triggered_at"),
        member("data.close_price").cast("double").alias("close_price"),
        member("data.rsi_14").cast("double").alias("rsi_14"),
        member("data.candle_pattern").alias("candle_pattern"),
    )


# ---- gaps --------------------------------------------------------------------------------


def _gap_symbols(spark, sf):
    return adapters.rules(spark, sf).select("symbol").distinct()


def downtime_gaps_of(spark, sf):
    return gaps.downtime_gaps(
        adapters.candles(spark, sf), _gap_symbols(spark, sf), adapters.events_end(spark, sf))


@query
def downtime_gaps(spark, sf):
    """From each symbol's last trade to the end of the data; one symbol was never traded."""
    return downtime_gaps_of(spark, sf)


@query
def missing_days(spark, sf):
    """Days on which a supplier shipped nothing."""
    daily = adapters.supplier_candles(spark, sf)
    listed = adapters.supplier_info(spark, sf).select("symbol")
    end = adapters.day_after(adapters.table(spark, sf, "lineitem"), "l_shipdate")
    return gaps.missing_days(daily, end, listed)


@query
def candle_gaps(spark, sf):
    return gaps.candle_gaps(adapters.candles(spark, sf))


@query
def backfill_ranges(spark, sf):
    return gaps.backfill_ranges(downtime_gaps_of(spark, sf))


# ---- views -------------------------------------------------------------------------------


@query
def gold_series(spark, sf):
    return views.gold_series(_bars(spark, sf, ("15m",)), "click", "15m").select(
        "window_start", "local_start", "open", "high", "low", "close", "volume"
    )


@query
def recent_alerts(spark, sf):
    return views.recent_alerts(adapters.alert_events(spark, sf)).select(
        "alert_id", "triggered_at", "local_triggered_at", "symbol", "action", "close_price"
    )


@query
def latest_bar_change(spark, sf):
    return views.latest_bar_change(_bars(spark, sf))


@query
def indicator_advice(spark, sf):
    """Advice on every bar, from indicators rounded as they are shown."""
    bars = resample.add_volume_ratio(resample.resample(_full_silver(spark, sf)))
    shown = ("rsi_14", "macd", "macd_signal", "volume_ratio", "ma25")
    rounded = bars.withColumns({c: F.round(c, 4) for c in shown})
    return views.with_advice(rounded).select(
        *resample.GOLD_KEY, "rsi_advice", "rsi_note", "macd_advice", "volume_advice", "momentum",
        "trend",
    )


@query
def local_time(spark, sf):
    return adapters.ticks(spark, sf).select(
        "trade_id", fn.local_time(F.col("trade_time")).alias("local_time")
    )


@query
def timeframe_seconds(spark, sf):
    """Length of every rule's timeframe and the number of rules that use it."""
    used = adapters.rules(spark, sf).groupBy("timeframe").agg(F.count(F.lit(1)).alias("rules"))
    seconds = fn.interval_seconds(F.col("timeframe"))
    return used.withColumns({"seconds": seconds, "millis": seconds * 1000})


@query
def minimum_slice(spark, sf):
    """Ticks to hourly bars with moving averages, RSI and VWAP: the flagship query."""
    silver = _silver(spark, sf, indicators.moving_averages, indicators.rsi_14)
    bars = resample.add_vwap(resample.resample(silver, ("1h",)))
    return bars.select(*BAR_FACTS, "ma7", "ma25", "ma99", "rsi_14", "vwap")
