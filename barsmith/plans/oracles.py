"""The same results in plain SQL over the test tables, written independently of the DataFrames.

Common table expressions build the candle model from ``events``; each oracle names the ones it
needs and their prerequisites follow.
"""

from __future__ import annotations


_CTE: dict[str, tuple[str, str]] = {}
ORACLES: dict[str, str] = {}


def _cte(name: str, needs: str, body: str) -> None:
    _CTE[name] = (needs, body)


def _sql(needs: str, body: str, recursive: bool = False) -> str:
    chosen: list[str] = []

    def add(name: str) -> None:
        for before in _CTE[name][0].split():
            add(before)
        if name not in chosen:
            chosen.append(name)

    for name in needs.split():
        add(name)
    if not chosen:
        return body
    parts = ",\n".join(f"{name} AS ({_CTE[name][1]})" for name in chosen)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"


#: Queries whose function itself rounds to the places shown.
ROUNDED_INSIDE = ("support_resistance", "volume_profile")


def _oracle(name: str, needs: str, body: str, recursive: bool = False) -> None:
    ORACLES[name] = _sql(needs, body, recursive)


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c.split('.')[-1]}" for c in columns)


# ---- candles -----------------------------------------------------------------------------

_cte("ticks", "", """
SELECT event_type AS symbol, ts, event_id, user_id, value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS qty
FROM events""")

_CANDLE_AGG = """
       max(ts) AS event_time, arg_min(price, (ts, event_id)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (ts, event_id)) AS close, sum(qty) AS volume,
       sum(price * qty) AS quote_volume, CAST(count(*) AS BIGINT) AS trade_count,
       sum(CASE WHEN user_id % 2 = 0 THEN qty ELSE 0 END) AS taker_buy_base_vol,
       sum(CASE WHEN user_id % 2 = 0 THEN price * qty ELSE 0 END) AS taker_buy_quote_vol"""

_cte("candles", "ticks", f"""
SELECT symbol, date_trunc('minute', ts) AS open_time,{_CANDLE_AGG}
FROM ticks GROUP BY ALL""")
_cte("half", "ticks", f"""
SELECT symbol, date_trunc('minute', ts) AS open_time,{_CANDLE_AGG}
FROM ticks WHERE second(ts) < 30 GROUP BY ALL""")

_cte("clean", "candles", "SELECT * FROM candles WHERE close > 0 AND volume >= 0 AND high >= low")


def _facts(alias: str = "", event: str = "event_time", source: str = "'ticks'", closed: str = "true") -> str:
    return f"""symbol, {event} AS event_time, open_time,
 open_time + INTERVAL 59999 MILLISECONDS AS close_time, '1m' AS "interval",
 {_r('open', 'high', 'low', 'close', 'volume', 'quote_volume')}, trade_count,
 {_r('taker_buy_base_vol', 'taker_buy_quote_vol')}, {closed} AS is_closed,
 {source} AS source, CAST(open_time AS DATE) AS partition_date"""


_MS = "date_trunc('milliseconds', event_time)"

_oracle("candles_1m", "candles", f"SELECT {_facts()} FROM candles")
_oracle("bronze_parse_candles", "candles", f"""
SELECT symbol AS _kafka_key, TIMESTAMP '2024-01-31 00:00:01' AS _kafka_ts,
 {_facts(event=_MS)} FROM candles""")
_oracle("bronze_valid", "candles", """
SELECT symbol, open_time, round(close, 4) AS close, CAST(open_time AS DATE) AS partition_date
FROM candles WHERE volume >= 20 AND symbol <> 'signup'""")
_oracle("parse_kline_messages", "half candles", f"""
SELECT {_facts(event=_MS, source="'websocket'", closed='is_closed')} FROM (
 SELECT *, true AS is_closed FROM candles UNION ALL SELECT *, false AS is_closed FROM half)
WHERE NOT (trade_count = 1 AND symbol IN ('error', 'view'))""")
_oracle("parse_trade_messages", "ticks", """
SELECT symbol, date_trunc('milliseconds', ts) AS event_time,
 TIMESTAMP '2024-01-31 00:00:01' AS ingest_time, event_id AS trade_id,
 round(price, 4) AS price, round(qty, 4) AS quantity, user_id AS buyer_order_id,
 CAST(NULL AS BIGINT) AS seller_order_id, date_trunc('milliseconds', ts) AS trade_time,
 user_id % 2 = 1 AS is_buyer_maker, 'websocket' AS source
FROM ticks WHERE price >= 1 AND NOT (symbol = 'click' AND qty = 99) AND qty NOT IN (2, 3)""")
_BOOK = """
SELECT symbol, TIMESTAMP '2024-01-31 00:00:01' AS ingest_time, event_id AS update_id,
 round(price, 4) AS best_bid, round(qty, 4) AS best_bid_qty,
 round(price + qty / 4 + 1, 4) AS best_ask, round(qty, 4) AS best_ask_qty,
 'websocket' AS source
FROM ticks WHERE qty > 0"""
_oracle("parse_book_messages", "ticks", _BOOK)
_oracle("book_spread", "ticks", """
SELECT event_id AS update_id, symbol, round(qty / 4 + 1, 4) AS spread FROM ticks WHERE qty > 0""")
_oracle("parse_rest_klines", "candles", f"""
SELECT {_facts(event='open_time', source="'rest'")} FROM candles WHERE trade_count <> 2""")
_oracle("route_messages", "ticks half candles", """
SELECT 'candles' AS route, symbol AS key, count(*) AS messages
FROM (SELECT symbol, trade_count FROM candles UNION ALL SELECT symbol, trade_count FROM half)
WHERE NOT (trade_count = 1 AND symbol IN ('error', 'view')) GROUP BY ALL
UNION ALL SELECT 'ticks', symbol, count(*) FROM ticks
 WHERE price >= 1 AND NOT (symbol = 'click' AND qty = 99) AND qty NOT IN (2, 3) GROUP BY ALL
UNION ALL SELECT 'book', symbol, count(*) FROM ticks WHERE qty > 0 GROUP BY ALL""")
_oracle("symbol_partition", "", """
SELECT symbol, CAST(CASE symbol WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
 WHEN 'signup' THEN 3 WHEN 'view' THEN 4
 ELSE CAST('0x' || substr(md5(symbol), 1, 8) AS BIGINT) % 5 END AS BIGINT) AS partition
FROM (SELECT event_type AS symbol FROM events UNION SELECT s_name FROM supplier)""")
_oracle("supported_symbols", "", """
SELECT event_type AS symbol, count(*) AS ticks FROM events
WHERE event_type IN ('click', 'error', 'purchase', 'signup') GROUP BY ALL""")
_oracle("unsupported_symbols", "", """
SELECT DISTINCT event_type AS symbol FROM events
WHERE event_type NOT IN ('click', 'error', 'purchase', 'signup')""")
_oracle("last_seen_per_symbol", "", """
SELECT event_type AS symbol, date_trunc('minute', max(ts)) AS last_open_time
FROM events GROUP BY ALL""")

# ---- silver ------------------------------------------------------------------------------

_oracle("silver_dedup", "candles", f"SELECT * EXCLUDE (source) FROM (SELECT {_facts()} FROM candles)")
_oracle("silver_clean", "clean", f"""
SELECT symbol, open_time, open_time + INTERVAL 59999 MILLISECONDS AS close_time,
 '1m' AS "interval", {_r('open', 'high', 'low', 'close', 'volume', 'quote_volume')},
 trade_count, {_r('taker_buy_base_vol')}, CAST(open_time AS DATE) AS partition_date
FROM clean WHERE trade_count > 1 OR CAST(epoch(open_time) AS BIGINT) // 60 % 7 <> 0""")

_PATTERN = """CASE
 WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR open = 0 THEN NULL
 WHEN least(open, close) - low >= 2 * abs(close - open)
  AND high - greatest(open, close) <= 0.5 * (least(open, close) - low) AND close > open THEN 'HAMMER'
 WHEN high - greatest(open, close) >= 2 * abs(close - open)
  AND least(open, close) - low <= 0.5 * (high - greatest(open, close)) AND close < open THEN 'SHOOTING_STAR'
 WHEN abs(close - open) / (CASE WHEN high = low THEN 1e-9 ELSE high - low END) < 0.05 THEN 'DOJI'
 WHEN abs(close - open) / (CASE WHEN high = low THEN 1e-9 ELSE high - low END) > 0.8
  THEN CASE WHEN close > open THEN 'BULLISH' ELSE 'BEARISH' END
 ELSE 'NEUTRAL' END"""


def _indicators(source: str, keys: str) -> list[tuple[str, str]]:
    """Three stacked selects: lagged values, first windows, windows over windows."""
    w = f"PARTITION BY {keys} ORDER BY open_time"

    def frame(n: int) -> str:
        return f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    return [
        ("lagged", f"SELECT *, lag(close) OVER ({w}) AS prev_close FROM {source}"),
        ("first", f"""
SELECT *, avg(close) {frame(7)} AS ma7, avg(close) {frame(25)} AS ma25,
 avg(close) {frame(99)} AS ma99, avg(close) {frame(20)} AS bb_middle,
 stddev_samp(close) {frame(20)} AS std20,
 greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range,
 CASE WHEN close > prev_close THEN close - prev_close ELSE 0 END AS gain,
 CASE WHEN close < prev_close THEN prev_close - close ELSE 0 END AS loss,
 avg(close) {frame(12)} - avg(close) {frame(26)} AS macd, avg(volume) {frame(20)} AS avg_volume_20
FROM @lagged"""),
        ("silver", f"""
SELECT *, bb_middle + 2 * std20 AS bb_upper, bb_middle - 2 * std20 AS bb_lower,
 (close - prev_close) / nullif(prev_close, 0) * 100 AS price_change_pct,
 avg(true_range) {frame(14)} AS atr_14,
 CASE WHEN avg(loss) {frame(14)} = 0 THEN 100.0
  ELSE 100 - 100 / (1 + avg(gain) {frame(14)} / avg(loss) {frame(14)}) END AS rsi_14,
 avg(macd) {frame(9)} AS macd_signal, macd - avg(macd) {frame(9)} AS macd_hist,
 volume / nullif(avg_volume_20, 0) AS volume_ratio,
 {_PATTERN} AS candle_pattern
FROM @first"""),
    ]


def _stack(prefix: str, source: str, keys: str = "symbol") -> None:
    needs = source
    for name, body in _indicators(source, keys):
        for other in ("lagged", "first"):
            body = body.replace(f"@{other}", f"{prefix}{other}")
        _cte(f"{prefix}{name}", needs, body)
        needs = f"{prefix}{name}"


_stack("", "clean")


def _silver_oracle(name: str, *columns: str) -> None:
    _oracle(name, "silver", f"SELECT symbol, open_time, {_r(*columns)} FROM silver")


_silver_oracle("moving_averages", "ma7", "ma25", "ma99")
_silver_oracle("bollinger_bands", "bb_middle", "bb_upper", "bb_lower")
_silver_oracle("price_change", "prev_close", "price_change_pct")
_silver_oracle("true_range", "true_range")
_silver_oracle("atr_14", "atr_14")
_silver_oracle("rsi_14", "rsi_14")
_silver_oracle("macd_sma", "macd", "macd_signal", "macd_hist")
_silver_oracle("volume_ratio", "avg_volume_20", "volume_ratio")
_oracle("candle_pattern", "clean", f"SELECT symbol, open_time, {_PATTERN} AS candle_pattern FROM clean")
_oracle("silver_full", "silver", f"""
SELECT symbol, open_time, open_time + INTERVAL 59999 MILLISECONDS AS close_time,
 '1m' AS "interval", {_r('open', 'high', 'low', 'close', 'volume', 'quote_volume')},
 trade_count, {_r('taker_buy_base_vol')}, CAST(open_time AS DATE) AS partition_date,
 {_r('ma7', 'ma25', 'ma99', 'bb_middle', 'bb_upper', 'bb_lower', 'prev_close', 'price_change_pct',
     'atr_14', 'rsi_14', 'macd', 'macd_signal', 'macd_hist', 'avg_volume_20', 'volume_ratio')},
 candle_pattern, TIMESTAMP '2024-01-31' AS processing_time FROM silver""")
_oracle("support_resistance", "clean", """
SELECT symbol, open_time, round((high + low + close) / 3, 4) AS pivot,
 round(2 * ((high + low + close) / 3) - low, 4) AS r1,
 round((high + low + close) / 3 + (high - low), 4) AS r2,
 round(2 * ((high + low + close) / 3) - high, 4) AS s1,
 round((high + low + close) / 3 - (high - low), 4) AS s2 FROM clean""")
_oracle("signal_strength", "silver", """
SELECT symbol, open_time, CASE WHEN score >= 3 THEN 'STRONG' WHEN score >= 2 THEN 'MODERATE' ELSE 'WEAK' END AS signal_type
FROM (SELECT symbol, open_time,
 CASE WHEN rsi < 30 OR rsi > 70 THEN 2 WHEN rsi < 40 OR rsi > 60 THEN 1 ELSE 0 END
 + CASE WHEN abs(m) > 0.001 THEN 1 ELSE 0 END + CASE WHEN v > 1.5 THEN 1 ELSE 0 END AS score
 FROM (SELECT symbol, open_time, round(rsi_14, 6) AS rsi, round(macd, 6) AS m, round(volume_ratio, 6) AS v FROM silver))""")

_cte("numbered", "clean", """
SELECT symbol, open_time, close, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS n,
 close - lag(close) OVER (PARTITION BY symbol ORDER BY open_time) AS delta FROM clean""")
_cte("ema", "numbered", """
SELECT symbol, open_time, n, close AS ema12, close AS ema26, CAST(0 AS DOUBLE) AS macd_signal
FROM numbered WHERE n = 1
UNION ALL
SELECT b.symbol, b.open_time, b.n, e.ema12 + 2.0 / 13 * (b.close - e.ema12),
 e.ema26 + 2.0 / 27 * (b.close - e.ema26),
 0.8 * e.macd_signal + 0.2 * (e.ema12 + 2.0 / 13 * (b.close - e.ema12) - e.ema26 - 2.0 / 27 * (b.close - e.ema26))
FROM ema e JOIN numbered b ON b.symbol = e.symbol AND b.n = e.n + 1""")
_oracle("macd_ema", "numbered ema", """
SELECT symbol, open_time, round(ema12, 4) AS ema12, round(ema26, 4) AS ema26,
 round(ema12 - ema26, 4) AS macd, round(macd_signal, 4) AS macd_signal FROM ema""", True)
_cte("wilder", "numbered", """
SELECT symbol, open_time, n, greatest(delta, 0) AS gain, greatest(-delta, 0) AS loss
FROM numbered WHERE n = 2
UNION ALL
SELECT b.symbol, b.open_time, b.n, (13 * w.gain + greatest(b.delta, 0)) / 14,
 (13 * w.loss + greatest(-b.delta, 0)) / 14
FROM wilder w JOIN numbered b ON b.symbol = w.symbol AND b.n = w.n + 1""")
_oracle("rsi_14_wilder", "numbered wilder", """
SELECT b.symbol, b.open_time, CASE WHEN b.n >= 15
 THEN round(100 - 100 / (1 + w.gain / nullif(w.loss, 0)), 4) END AS rsi_14_wilder
FROM numbered b LEFT JOIN wilder w ON w.symbol = b.symbol AND w.n = b.n""", True)

# ---- history -----------------------------------------------------------------------------

_DAY = "(SELECT date_trunc('day', max(ts)) FROM events)"
_END = "(SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM events)"
_oracle("batch_keys", "candles", f"""
SELECT DISTINCT symbol, '1m' AS "interval" FROM candles WHERE open_time >= {_DAY}""")
_oracle("history_without_batch", "candles", f"""
SELECT symbol, '1m' AS "interval", open_time, round(close, 4) AS close
FROM candles WHERE open_time < {_DAY}""")
_oracle("latest_n_per_key", "candles", f"""
SELECT symbol, '1m' AS "interval", open_time, round(close, 4) AS close FROM candles
WHERE open_time < {_DAY} AND symbol IN (SELECT symbol FROM candles WHERE open_time >= {_DAY})
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 100""")
_oracle("union_missing_columns", "candles", f"""
SELECT symbol, open_time, round(close, 4) AS close,
 CASE WHEN open_time >= {_DAY} THEN round(quote_volume, 4) END AS quote_volume,
 open_time >= {_DAY} AS is_new FROM candles""")
_oracle("batch_metrics", "candles", """
SELECT CAST(open_time AS DATE) AS partition_date, count(*) AS rows_read,
 count(*) FILTER (close > 0 AND volume >= 0 AND high >= low) AS rows_valid,
 count(*) FILTER (NOT (close > 0 AND volume >= 0 AND high >= low)) AS rows_rejected
FROM candles GROUP BY 1""")

# ---- bars --------------------------------------------------------------------------------

_cte("sizes", "", """
SELECT * FROM (VALUES ('5m', 300), ('15m', 900), ('1h', 3600), ('4h', 14400), ('1d', 86400))
 AS t(timeframe, seconds)""")
_BUCKET = "make_timestamp(CAST(epoch(open_time) AS BIGINT) // seconds * seconds * 1000000)"
_BAR_AGG = """
 arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
 arg_max(close, open_time) AS close, sum(volume) AS volume, sum(quote_volume) AS quote_volume,
 CAST(sum(trade_count) AS BIGINT) AS trade_count"""
_cte("bars", "clean sizes", f"""
SELECT symbol, timeframe, seconds, {_BUCKET} AS window_start,{_BAR_AGG}
FROM clean CROSS JOIN sizes GROUP BY 1, 2, 3, 4""")
_CARRIED = ("ma7", "ma25", "ma99", "rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper",
            "bb_lower", "atr_14", "price_change_pct")
_LAST = ", ".join(
    f"arg_max({c}, open_time) FILTER ({c} IS NOT NULL) AS {c}" for c in (*_CARRIED, "candle_pattern")
)
_cte("full_bars", "silver sizes", f"""
SELECT symbol, timeframe, seconds, {_BUCKET} AS window_start,{_BAR_AGG}, {_LAST}
FROM silver CROSS JOIN sizes GROUP BY 1, 2, 3, 4""")
_BAR_FACTS = f"""symbol, timeframe, window_start,
 window_start + to_seconds(seconds) AS window_end,
 {_r('open', 'high', 'low', 'close', 'volume', 'quote_volume')}, trade_count"""
for _name in ("5m", "15m", "1h", "4h", "1d"):
    _oracle(f"resample_{_name}", "bars", f"SELECT {_BAR_FACTS} FROM bars WHERE timeframe = '{_name}'")
_oracle("resample_all", "full_bars", f"SELECT {_BAR_FACTS}, {_r(*_CARRIED)}, candle_pattern FROM full_bars")

_GW = "PARTITION BY symbol, timeframe ORDER BY window_start"
_VWAP = f"""sum((high + low + close) / 3 * volume) OVER ({_GW} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)
 / nullif(sum(volume) OVER ({_GW} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW), 0)"""
_RATIO = f"volume / nullif(avg(volume) OVER ({_GW} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0)"
_KEY = "symbol, timeframe, window_start"
_oracle("vwap", "bars", f"SELECT {_KEY}, round({_VWAP}, 4) AS vwap FROM bars")
_oracle("gold_volume_ratio", "bars", f"SELECT {_KEY}, round({_RATIO}, 4) AS volume_ratio FROM bars")
_oracle("gold_with_metadata", "bars", f"""
SELECT {_KEY}, round(close, 4) AS close, round({_VWAP}, 4) AS vwap, round({_RATIO}, 4) AS volume_ratio,
 CAST(window_start AS DATE) AS partition_date, TIMESTAMP '2024-01-31' AS aggregated_at,
 name, base_asset, consensus, CAST(cmc_rank AS BIGINT) AS cmc_rank
FROM bars LEFT JOIN (VALUES ('click', 'Click', 'CLK', 'Proof-of-Work', 1),
 ('error', 'Error', 'ERR', 'Proof-of-Stake', 2), ('purchase', 'Purchase', 'PUR', 'BNB Chain', 3),
 ('signup', 'Signup', 'SGN', 'PoH+PoS', 4)) AS d(symbol, name, base_asset, consensus, cmc_rank)
USING (symbol)""")
_oracle("price_rank", "bars", f"""
SELECT {_KEY}, rank() OVER (PARTITION BY timeframe, window_start ORDER BY volume DESC) AS price_rank FROM bars""")
_oracle("volume_dense_rank", "bars", f"""
SELECT {_KEY}, dense_rank() OVER (PARTITION BY timeframe, window_start ORDER BY volume DESC) AS volume_dense_rank FROM bars""")
_oracle("cumulative_volume", "bars", f"""
SELECT {_KEY}, round(sum(volume) OVER ({_GW} ROWS UNBOUNDED PRECEDING), 4) AS cumulative_volume FROM bars""")
_cte("gold", "full_bars", f"SELECT *, {_VWAP} AS vwap, {_RATIO} AS volume_ratio FROM full_bars")
_PREV = ("close", "rsi_14", "macd", "macd_signal")
_oracle("prev_values", "gold", f"SELECT {_KEY}, " + ", ".join(
    f"round(lag({c}) OVER ({_GW}), 4) AS prev_{c}" for c in _PREV) + " FROM gold")
_oracle("pivot_metrics", "bars", "SELECT timeframe, window_start, " + ", ".join(
    f"round(max(close) FILTER (symbol = '{s}'), 4) AS {s}"
    for s in ("click", "error", "purchase", "signup", "view")
) + " FROM bars GROUP BY 1, 2")
_oracle("unpivot_metrics", "full_bars", f"""
SELECT {_KEY}, metric_name, round(metric_value, 4) AS metric_value FROM (
 SELECT {_KEY}, 'close' AS metric_name, close AS metric_value FROM full_bars
 UNION ALL SELECT {_KEY}, 'volume', volume FROM full_bars
 UNION ALL SELECT {_KEY}, 'rsi_14', rsi_14 FROM full_bars)""")
_oracle("realtime_gate", "bars", f"""
SELECT {_KEY}, round(close, 4) AS close FROM bars WHERE window_start >= {_DAY}""")
_cte("bar_batch", "bars", f"""
SELECT symbol, timeframe, min(window_start) AS first FROM bars WHERE window_start >= {_DAY} GROUP BY ALL""")
_oracle("latest_n_bars_per_key", "bar_batch", f"""
SELECT {_KEY}, round(close, 4) AS close FROM bars JOIN bar_batch USING (symbol, timeframe) WHERE window_start < first
QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY window_start DESC) <= 20""")
_cte("versions", "clean sizes", f"""
SELECT symbol, timeframe, seconds, {_BUCKET} AS window_start,
 CAST(epoch(open_time) AS BIGINT) // 36000 AS batch_id,{_BAR_AGG}
FROM clean CROSS JOIN sizes GROUP BY 1, 2, 3, 4, 5""")
_oracle("gold_upsert", "versions", f"""
SELECT symbol, timeframe, window_start, window_start + to_seconds(seconds) AS window_end,
 """ + ", ".join(
    f"round(arg_max({c}, batch_id), 4) AS {c}" for c in ("open", "high", "low", "close", "volume", "quote_volume")
) + """, arg_max(trade_count, batch_id) AS trade_count FROM versions GROUP BY symbol, timeframe, window_start, seconds""")
_oracle("minimum_slice", "full_bars", f"""
SELECT {_BAR_FACTS}, {_r('ma7', 'ma25', 'ma99', 'rsi_14')}, round({_VWAP}, 4) AS vwap
FROM full_bars WHERE timeframe = '1h'""")
_oracle("volume_profile", "bars", """
SELECT symbol, timeframe, CAST(floor(round(low + (high - low) / 10 * (i + 0.5), 4)) AS BIGINT) AS price,
 count(*) AS steps, round(sum(round(volume / 10, 4)), 4) AS volume
FROM bars CROSS JOIN range(10) AS t(i) WHERE high <> low GROUP BY 1, 2, 3""")

# ---- suppliers ---------------------------------------------------------------------------

_cte("supplier_candles", "", """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS open_time,
 arg_min(price, tie) AS open, max(price) AS high, min(price) AS low, arg_max(price, tie) AS close,
 sum(qty) AS volume, sum(price * qty) AS quote_volume, count(*) AS trade_count,
 sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE qty END) AS taker_buy_base_vol
FROM (SELECT *, l_extendedprice / l_quantity AS price, l_quantity AS qty,
 (l_orderkey, l_linenumber, l_partkey) AS tie FROM lineitem) GROUP BY 1, 2""")
_oracle("supplier_candles_1d", "supplier_candles", f"""
SELECT symbol, open_time, {_r('open', 'high', 'low', 'close', 'volume', 'quote_volume')},
 trade_count, {_r('taker_buy_base_vol')} FROM supplier_candles""")
_stack("s", "supplier_candles")
_oracle("supplier_indicators", "ssilver", f"""
SELECT symbol, open_time, {_r('ma7', 'ma25', 'ma99', 'bb_upper', 'bb_lower', 'atr_14', 'rsi_14',
                              'macd', 'macd_signal', 'volume_ratio')} FROM ssilver""")
_oracle("supplier_metadata", "supplier_candles", """
SELECT r_name AS region, n_name AS nation, count(*) AS candles, round(sum(volume), 4) AS volume,
 round(max(high), 4) AS high
FROM supplier_candles LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey) ON symbol = CAST(s_suppkey AS VARCHAR) GROUP BY ALL""")

# ---- rules and events --------------------------------------------------------------------


def _owner(key: str) -> str:
    return f"""'rule-' || {key} AS rule_id, 'user-' || ({key} % 25) AS user_id,
 ['click', 'error', 'purchase', 'signup', 'view', 'refund'][{key} % 6 + 1] AS symbol,
 ['5m', '15m', '1h', '4h', '1d'][({key} // 6) % 5 + 1] AS timeframe"""


_cte("rules", "", f"""
SELECT {_owner('c_custkey')}, c_custkey, c_mktsegment, c_acctbal,
 CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'OR' ELSE 'AND' END AS logic,
 ['BUY', 'SELL', 'WATCH'][c_nationkey % 3 + 1] AS action,
 CASE WHEN c_acctbal < 2000 THEN ['email'] WHEN c_acctbal < 6000 THEN ['email', 'webhook']
  ELSE ['webhook'] END AS channels,
 CAST(c_custkey % 4 * 1200 + 600 AS BIGINT) AS cooldown_seconds, c_acctbal < 9000 AS is_active,
 TIMESTAMP '2024-01-01' + to_minutes(c_custkey) AS created_at,
 CASE WHEN c_acctbal >= 3000 THEN TIMESTAMP '2024-01-31' - to_seconds((c_custkey * 37) % 7200) END AS last_triggered_at
FROM customer""")
_cte("conds", "rules", """
SELECT rule_id, symbol, timeframe, is_active, idx, field, op,
 CASE WHEN op_value IS NULL THEN CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) * scale + base AS VARCHAR) ELSE op_value END AS value
FROM rules JOIN (VALUES
 ('BUILDING', 1, 'rsi_14', '<', NULL, 1, 30), ('BUILDING', 2, 'volume_ratio', '>', '1.05', 0, 0),
 ('MACHINERY', 1, 'close', 'crosses_above', NULL, 10, 0), ('MACHINERY', 2, 'low', '>=', '1', 0, 0),
 ('AUTOMOBILE', 1, 'candle_pattern', '==', 'hammer', 0, 0), ('AUTOMOBILE', 2, 'volume_ratio', '>=', '0.9', 0, 0),
 ('FURNITURE', 1, 'rsi_14', '>', NULL, 1, 60), ('FURNITURE', 2, 'macd_hist', 'between', '0', 0, 0),
 ('FURNITURE', 3, 'candle_pattern', '!=', 'NEUTRAL', 0, 0),
 ('HOUSEHOLD', 1, 'macd', 'crosses_below', NULL, 1, -5), ('HOUSEHOLD', 2, 'spread', '>', '0', 0, 0),
 ('HOUSEHOLD', 3, 'close', '<=', '0.5', 0, 0)
) AS t(segment, idx, field, op, op_value, scale, base) ON segment = c_mktsegment
WHERE c_acctbal >= 0""")
_cte("cond_text", "conds", """
SELECT rule_id, string_agg(field || ' ' || op || ' ' || value, '; ' ORDER BY idx) AS conditions
FROM conds GROUP BY 1""")
_oracle("active_rules", "rules cond_text", """
SELECT rule_id, user_id, symbol, timeframe, action, cooldown_seconds, last_triggered_at,
 coalesce(conditions, '') AS conditions, logic
FROM rules LEFT JOIN cond_text USING (rule_id) WHERE is_active""")
_oracle("rule_by_id", "rules cond_text", """
SELECT rule_id, symbol, timeframe, coalesce(conditions, '') AS conditions, logic, action
FROM rules LEFT JOIN cond_text USING (rule_id) WHERE rule_id = 'rule-57' AND user_id = 'user-7'""")
_oracle("rules_page", "rules", """
SELECT rule_id, user_id, symbol, timeframe, created_at, count(*) OVER () AS total
FROM rules WHERE user_id = 'user-7' AND is_active ORDER BY created_at DESC, rule_id DESC LIMIT 10 OFFSET 10""")
_oracle("timeframe_seconds", "rules sizes", """
SELECT timeframe, count(*) AS rules, CAST(seconds AS BIGINT) AS seconds, CAST(seconds * 1000 AS BIGINT) AS millis
FROM rules JOIN sizes USING (timeframe) GROUP BY ALL""")

# A payload is wrong by its owner's nation, by a low or high cooldown, or for want of conditions.
_cte("payloads", "", f"""
SELECT {_owner('c_custkey')}, CASE WHEN c_nationkey <> 16 THEN 'new-' || c_custkey END AS new_id,
 unnest(CASE WHEN c_nationkey = 16 THEN ['email', 'webhook'] WHEN c_nationkey = 8 THEN ['sms']
  WHEN c_nationkey = 15 THEN ['email'] ELSE ['email,webhook'] END) AS channels, c_nationkey AS nation, c_acctbal, c_mktsegment,
 CASE WHEN c_nationkey = 13 THEN 300 ELSE CAST(floor(c_acctbal * 10) AS BIGINT) END AS cooldown
FROM customer""")
_cte("violations", "payloads", """
SELECT new_id AS rule_id, 'condition count' AS violation FROM payloads
 WHERE nation = 5 OR (nation > 5 AND c_acctbal < 0)
UNION ALL SELECT new_id, 'condition value' FROM payloads
 WHERE nation <= 3 OR (nation > 5 AND c_acctbal >= 0 AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD'))
UNION ALL SELECT new_id, 'logic' FROM payloads WHERE nation = 7
UNION ALL SELECT new_id, 'action' FROM payloads WHERE nation = 9
UNION ALL SELECT new_id, 'timeframe' FROM payloads WHERE nation = 6
UNION ALL SELECT new_id, 'cooldown' FROM payloads WHERE cooldown < 60 OR cooldown > 86400
UNION ALL SELECT new_id, 'channel' FROM payloads WHERE nation = 8
UNION ALL SELECT new_id, 'email address' FROM payloads WHERE nation = 10
UNION ALL SELECT new_id, 'webhook url' FROM payloads WHERE nation IN (11, 12)""")
_oracle("rule_violations", "violations", "SELECT rule_id, violation FROM violations")
_oracle("rules_created", "rules cond_text violations", """
SELECT rule_id, user_id, symbol, timeframe, coalesce(conditions, '') AS conditions, logic, action,
 array_to_string(channels, ',') AS channels,
 cooldown_seconds, is_active, created_at, CAST(0 AS BIGINT) AS trigger_count
FROM rules LEFT JOIN cond_text USING (rule_id)
UNION ALL
SELECT new_id, user_id, upper(symbol), '1h',
 CASE WHEN nation = 4 THEN 'candle_pattern == bullish_engulfing' ELSE coalesce(conditions, '') END, 'AND', 'BUY',
 channels, cooldown, true, TIMESTAMP '2024-01-31', 0
FROM payloads LEFT JOIN cond_text USING (rule_id)
WHERE NOT (nation = 5 OR nation > 5 AND c_acctbal < 0 OR nation <= 3
 OR nation > 5 AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') OR nation IN (6, 7, 8, 9, 10, 11, 12)
 OR cooldown < 60 OR cooldown > 86400)""")

_cte("alert_events", "", f"""
SELECT 'alert-' || o_orderkey AS alert_id, o_orderkey, {_owner('o_custkey')},
 CASE o_orderstatus WHEN 'P' THEN 'BUY' WHEN 'F' THEN 'SELL' ELSE 'WATCH' END AS action,
 o_orderdate + to_seconds(o_orderkey % 86400) AS triggered_at, o_totalprice AS close_price,
 CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey % 101 AS DOUBLE) END AS rsi_14,
 CAST(o_orderkey % 2001 - 1000 AS DOUBLE) / 100 AS macd,
 CAST(o_custkey % 500 AS DOUBLE) / 100 AS volume_ratio,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'HAMMER' WHEN '2-HIGH' THEN 'DOJI' WHEN '3-MEDIUM' THEN 'BULLISH' END AS candle_pattern,
 o_orderpriority AS message
FROM orders""")
_EVENT = f"""alert_id, rule_id, user_id, symbol, timeframe, action, triggered_at,
 {_r('close_price', 'rsi_14', 'macd', 'volume_ratio')}, candle_pattern, message"""
_cte("patches", "alert_events", """
SELECT rule_id AS p_rule, arg_max(action, (triggered_at, alert_id)) AS p_action,
 arg_max(message, (triggered_at, alert_id)) = '1-URGENT' AS p_active, bool_or(message = '1-URGENT') AS p_urgent
FROM alert_events WHERE message IN ('1-URGENT', '2-HIGH') GROUP BY 1""")
_oracle("rules_patched", "rules patches", """
SELECT rule_id, user_id, coalesce(p_action, action) AS action,
 CASE WHEN p_urgent THEN CAST(60 AS BIGINT) ELSE cooldown_seconds END AS cooldown_seconds,
 CASE WHEN p_urgent THEN 'OR' ELSE logic END AS logic,
 coalesce(p_active, is_active) AS is_active,
 CASE WHEN p_rule IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE created_at END AS updated_at
FROM rules LEFT JOIN patches ON rule_id = p_rule""")
_oracle("patch_violations", "alert_events", """
SELECT rule_id, user_id, CASE WHEN message = '3-MEDIUM' THEN 'cooldown' ELSE 'logic' END AS violation
FROM alert_events WHERE message = '3-MEDIUM' OR message LIKE '4%'""")
_oracle("rules_toggled", "rules alert_events", """
SELECT rule_id, user_id, action, cooldown_seconds, logic, is_active <> hit AS is_active,
 CASE WHEN hit THEN TIMESTAMP '2024-01-31' ELSE created_at END AS updated_at
FROM (SELECT *, rule_id IN (SELECT rule_id FROM alert_events WHERE message = '1-URGENT' AND action = 'BUY') AS hit FROM rules)""")
_oracle("rules_deleted", "rules", """
SELECT rule_id, user_id, action, cooldown_seconds, logic, is_active, created_at AS updated_at
FROM rules WHERE c_mktsegment <> 'FURNITURE'""")
_oracle("rule_history", "alert_events", f"""
SELECT {_EVENT} FROM alert_events
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY triggered_at DESC, alert_id DESC) <= 5""")
_oracle("rule_trigger_stats", "rules alert_events", """
SELECT rule_id, greatest(last_triggered_at, max(triggered_at)) AS last_triggered_at,
 count(alert_id) AS trigger_count
FROM rules LEFT JOIN (SELECT rule_id, triggered_at, alert_id FROM alert_events) USING (rule_id)
GROUP BY rule_id, last_triggered_at""")

# ---- alerts ------------------------------------------------------------------------------

_FIELDS = ("close", "low", "rsi_14", "macd", "macd_hist", "volume_ratio")
_cte("rule_bars", "gold", "SELECT *, " + ", ".join(
    f"lag({c}) OVER ({_GW}) AS prev_{c}" for c in _FIELDS) + " FROM gold")


def _pick_field(prefix: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN {prefix}{c}" for c in _FIELDS)
    return f"CASE field {cases} END"


_cte("tested", "rule_bars conds", f"""
SELECT *, coalesce(CASE
 WHEN field = 'candle_pattern' THEN CASE op WHEN '==' THEN candle_pattern = upper(value) WHEN '!=' THEN candle_pattern <> upper(value) END
 ELSE CASE op WHEN '>' THEN cur > num WHEN '<' THEN cur < num WHEN '>=' THEN cur >= num WHEN '<=' THEN cur <= num
  WHEN 'crosses_above' THEN prev <= num AND cur > num WHEN 'crosses_below' THEN prev >= num AND cur < num END END, false) AS met
FROM (SELECT c.rule_id, c.idx, c.field, c.op, c.value, TRY_CAST(c.value AS DOUBLE) AS num, b.*,
 {_pick_field('')} AS cur, {_pick_field('prev_')} AS prev
 FROM conds c JOIN rule_bars b ON b.symbol = c.symbol AND b.timeframe = c.timeframe WHERE c.is_active)""")
_oracle("conditions_evaluated", "tested", """
SELECT symbol, timeframe, field, op AS operator, value, count(*) AS bars,
 CAST(sum(CAST(met AS INT)) AS BIGINT) AS bars_met
FROM (SELECT DISTINCT symbol, timeframe, window_start, field, op, value, met FROM tested) GROUP BY ALL""")
_cte("matched", "tested rules", """
SELECT rule_id, t.symbol, t.timeframe, window_start FROM tested t JOIN rules r USING (rule_id)
GROUP BY rule_id, t.symbol, t.timeframe, window_start, logic
HAVING CASE logic WHEN 'AND' THEN bool_and(met) ELSE bool_or(met) END""")
_oracle("rules_matched", "matched", """
SELECT rule_id, symbol, timeframe, count(*) AS bars_met, min(window_start) AS first_window,
 max(window_start) AS last_window FROM matched GROUP BY ALL""")
_cte("latest", "matched", """
SELECT rule_id, symbol, timeframe, max(window_start) AS window_start FROM matched GROUP BY ALL""")
_oracle("alerts_with_reasons", "latest tested", """
SELECT l.rule_id, l.symbol, l.timeframe, l.window_start, string_agg(
 CASE WHEN field = 'candle_pattern' AND candle_pattern IS NULL OR field <> 'candle_pattern' AND cur IS NULL THEN field || ' is None'
  WHEN op LIKE 'crosses%' AND prev IS NULL THEN 'No previous data for ' || field
  WHEN op = 'between' THEN 'Unknown operator: between'
  ELSE field || ' ' || op || ' ' || value || ' → ' || CASE WHEN met THEN '✓' ELSE '✗' END END, '; ' ORDER BY idx) AS reasons
FROM latest l JOIN tested t ON t.rule_id = l.rule_id AND t.window_start = l.window_start GROUP BY ALL""")
_COOL = """(last_triggered_at IS NULL OR epoch(TIMESTAMP '2024-01-31') - epoch(last_triggered_at) > cooldown_seconds)"""
_oracle("alerts_after_cooldown", "latest rules", f"""
SELECT rule_id, l.symbol, l.timeframe, window_start FROM latest l JOIN rules USING (rule_id) WHERE {_COOL}""")
_oracle("alerts_triggered", "latest rules rule_bars", f"""
SELECT sha256(rule_id || '|' || l.symbol || '|' || l.timeframe || '|' || strftime(l.window_start, '%Y-%m-%d %H:%M:%S') || '|2024-01-31 00:00:00') AS alert_id,
 rule_id, user_id, l.symbol, l.timeframe, action, TIMESTAMP '2024-01-31' AS triggered_at,
 round(close, 4) AS close_price, round(rsi_14, 4) AS rsi_14, round(macd, 4) AS macd,
 round(volume_ratio, 4) AS volume_ratio, candle_pattern, l.window_start
FROM latest l JOIN rules r USING (rule_id)
JOIN rule_bars b ON b.symbol = l.symbol AND b.timeframe = l.timeframe AND b.window_start = l.window_start
WHERE {_COOL}""")
_oracle("format_signal", "alert_events", """
SELECT alert_id, round(close_price, 4) AS close_price, round(rsi_14, 2) AS rsi_14, round(macd, 4) AS macd,
 round(volume_ratio, 2) AS volume_ratio, symbol, action, candle_pattern, rule_id,
 CASE WHEN score >= 3 THEN 'STRONG' WHEN score >= 2 THEN 'MODERATE' ELSE 'WEAK' END AS signal_type
FROM (SELECT *, CASE WHEN rsi_14 < 30 OR rsi_14 > 70 THEN 2 WHEN rsi_14 < 40 OR rsi_14 > 60 THEN 1 ELSE 0 END
 + CASE WHEN abs(macd) > 0.001 THEN 1 ELSE 0 END + CASE WHEN volume_ratio > 1.5 THEN 1 ELSE 0 END AS score FROM alert_events)""")
_oracle("alerts_deduped", "alert_events", """
SELECT rule_id, arg_max(alert_id, ord) AS alert_id, max(triggered_at) AS window_start
FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY triggered_at, alert_id DESC) AS ord FROM alert_events) GROUP BY 1""")
_oracle("alert_messages", "alert_events", """
SELECT symbol AS key, alert_id, triggered_at, round(close_price, 4) AS close_price, candle_pattern FROM alert_events""")
_BROKEN = "action = 'BUY' AND message = '1-URGENT'"
_LACKING = "action = 'SELL' AND message = '5-LOW'"
_oracle("alert_events_valid", "alert_events", f"""
SELECT {_EVENT} FROM alert_events WHERE NOT ({_BROKEN}) AND NOT ({_LACKING})""")
_oracle("alert_dead_letters", "alert_events", f"""
SELECT TIMESTAMP '2024-01-31' AS "timestamp", CASE WHEN {_BROKEN} THEN 'invalid JSON'
 ELSE 'missing required fields: user_id' END AS error, o_orderkey AS order_number
FROM alert_events WHERE ({_BROKEN}) OR ({_LACKING})""")
_cte("kept", "rules", "SELECT * FROM rules WHERE c_mktsegment <> 'FURNITURE'")
_oracle("dispatch_rows", "alert_events kept", """
SELECT alert_id, rule_id, channel,
 CASE WHEN channel = 'email' THEN 'c' || c_custkey || '@example.com' ELSE 'https://hooks.example.com/' || c_custkey END AS target,
 triggered_at
FROM alert_events JOIN (SELECT rule_id, c_custkey, unnest(channels) AS channel FROM kept) USING (rule_id)""")
_oracle("dispatch_rejects", "alert_events kept", """
SELECT alert_id, rule_id FROM alert_events WHERE rule_id NOT IN (SELECT rule_id FROM kept)""")
_oracle("alert_text", "alert_events", """
SELECT alert_id, concat_ws(chr(10), '[' || action || ' SIGNAL]', '',
 'Symbol:       ' || symbol || ' (' || timeframe || ')',
 'Price:        ' || printf('%.4f USDT', close_price),
 'RSI(14):      ' || coalesce(printf('%.2f', rsi_14), 'N/A'),
 'MACD:         ' || printf('%.4f', macd), 'Volume Ratio: ' || printf('%.2fx', volume_ratio),
 'Pattern:      ' || coalesce(candle_pattern, 'N/A'),
 'Triggered At: ' || strftime(triggered_at, '%Y-%m-%dT%H:%M:%S'),
 'Rule ID:      ' || left(rule_id, 12) || '...', '', '---', 'Automated Alert') AS text
FROM alert_events""")
_oracle("webhook_payload", "alert_events", """
SELECT alert_id, 'alert_triggered' AS event_type, user_id,
 strftime(triggered_at, '%Y-%m-%d %H:%M:%S') AS triggered_at, round(close_price, 4) AS close_price,
 round(rsi_14, 4) AS rsi_14, candle_pattern FROM alert_events""")

# ---- gaps --------------------------------------------------------------------------------

_cte("downtime", "candles rules", f"""
SELECT symbol, coalesce(max(open_time), (SELECT min(open_time) FROM candles)) AS gap_start, {_END} AS gap_end
FROM (SELECT DISTINCT symbol FROM rules) LEFT JOIN candles USING (symbol) GROUP BY 1
HAVING {_END} - coalesce(max(open_time), (SELECT min(open_time) FROM candles)) >= INTERVAL 120 SECONDS""")
_oracle("downtime_gaps", "downtime", "SELECT * FROM downtime")
_oracle("missing_days", "", """
SELECT symbol, CAST(day AS DATE) AS day FROM (
 SELECT CAST(s_suppkey AS VARCHAR) AS symbol, unnest(generate_series(
  coalesce(first, (SELECT min(l_shipdate) FROM lineitem)), (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY)) AS day
 FROM supplier LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS first FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey)
ANTI JOIN (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS day FROM lineitem) USING (symbol, day)""")
_oracle("candle_gaps", "candles", """
SELECT symbol, '1m' AS "interval", last_time + INTERVAL 1 MINUTE AS gap_start, open_time AS gap_end,
 date_diff('minute', last_time, open_time) - 1 AS missing
FROM (SELECT symbol, open_time, lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS last_time FROM candles)
WHERE date_diff('minute', last_time, open_time) > 1""")
_oracle("backfill_ranges", "downtime", """
SELECT symbol, request_start, least(request_start + INTERVAL 1000 MINUTES, gap_end) AS request_end FROM (
 SELECT symbol, gap_end, unnest(generate_series(gap_start, gap_end - INTERVAL 1 SECOND, INTERVAL 1000 MINUTES)) AS request_start
 FROM downtime WHERE gap_start < gap_end)""")

# ---- views -------------------------------------------------------------------------------

_oracle("gold_series", "bars", f"""
SELECT window_start, window_start + INTERVAL 7 HOURS AS local_start, {_r('open', 'high', 'low', 'close', 'volume')}
FROM bars WHERE symbol = 'click' AND timeframe = '15m' ORDER BY window_start DESC LIMIT 300""")
_oracle("recent_alerts", "alert_events", """
SELECT alert_id, triggered_at, triggered_at + INTERVAL 7 HOURS AS local_triggered_at, symbol, action,
 round(close_price, 4) AS close_price
FROM alert_events ORDER BY triggered_at DESC, alert_id DESC LIMIT 50""")
_oracle("latest_bar_change", "bars", f"""
SELECT symbol, timeframe, window_start, round(close, 4) AS close, round(prev, 4) AS prev_close,
 round((close - prev) / nullif(prev, 0) * 100, 4) AS change_pct
FROM (SELECT *, coalesce(lag(close) OVER ({_GW}), close) AS prev,
 row_number() OVER (PARTITION BY symbol, timeframe ORDER BY window_start DESC) AS rn FROM bars) WHERE rn = 1""")
_oracle("indicator_advice", "full_bars", f"""
SELECT {_KEY},
 CASE WHEN rsi > 70 THEN 'SELL / OVERBOUGHT' WHEN rsi < 30 THEN 'BUY / OVERSOLD' ELSE 'NEUTRAL' END AS rsi_advice,
 CASE WHEN rsi IS NULL THEN 'Waiting for data...' WHEN rsi > 70 THEN 'Price is likely stretched high.'
  WHEN rsi < 30 THEN 'Price might be undervalued.' ELSE 'Market is in balance.' END AS rsi_note,
 CASE WHEN m IS NULL OR s IS NULL THEN 'NEUTRAL' WHEN m > s THEN 'BULLISH MOMENTUM' ELSE 'BEARISH MOMENTUM' END AS macd_advice,
 CASE WHEN v > 1.5 THEN 'HIGH SURGE' ELSE 'NORMAL' END AS volume_advice,
 CASE WHEN m > 0 THEN 'Positive' ELSE 'Negative' END AS momentum,
 CASE WHEN close > coalesce(t, 0) THEN 'Bullish' ELSE 'Bearish' END AS trend
FROM (SELECT {_KEY}, close, round(rsi_14, 4) AS rsi, round(macd, 4) AS m, round(macd_signal, 4) AS s,
 round({_RATIO}, 4) AS v, round(ma25, 4) AS t FROM full_bars)""")
_oracle("local_time", "", "SELECT event_id AS trade_id, ts + INTERVAL 7 HOURS AS local_time FROM events")
