"""Row layouts of the layers, as DDL.

Fixed values: column names, types and order are the public data contract of the tables.
Prices are doubles throughout. Missing required values are removed by explicit filters,
because a reader does not enforce NOT NULL on parsed JSON.
"""

CANDLE = """
symbol STRING, event_time TIMESTAMP, ingest_time TIMESTAMP, open_time TIMESTAMP,
close_time TIMESTAMP, interval STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE,
volume DOUBLE, quote_volume DOUBLE, trade_count INT, taker_buy_base_vol DOUBLE,
taker_buy_quote_vol DOUBLE, is_closed BOOLEAN, source STRING, partition_date DATE
"""

TICK = """
symbol STRING, event_time TIMESTAMP, ingest_time TIMESTAMP, trade_id BIGINT, price DOUBLE,
quantity DOUBLE, buyer_order_id BIGINT, seller_order_id BIGINT, trade_time TIMESTAMP,
is_buyer_maker BOOLEAN, source STRING
"""

BOOK = """
symbol STRING, ingest_time TIMESTAMP, update_id BIGINT, best_bid DOUBLE, best_bid_qty DOUBLE,
best_ask DOUBLE, best_ask_qty DOUBLE, source STRING
"""

SILVER = """
symbol STRING, open_time TIMESTAMP, close_time TIMESTAMP, interval STRING, open DOUBLE,
high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trade_count INT,
taker_buy_base_vol DOUBLE, partition_date DATE, ma7 DOUBLE, ma25 DOUBLE, ma99 DOUBLE,
bb_upper DOUBLE, bb_lower DOUBLE, bb_middle DOUBLE, rsi_14 DOUBLE, macd DOUBLE,
macd_signal DOUBLE, macd_hist DOUBLE, atr_14 DOUBLE, avg_volume_20 DOUBLE,
volume_ratio DOUBLE, candle_pattern STRING, price_change_pct DOUBLE, prev_close DOUBLE,
ingest_time TIMESTAMP, processing_time TIMESTAMP
"""

GOLD = """
symbol STRING, timeframe STRING, window_start TIMESTAMP, window_end TIMESTAMP, open DOUBLE,
high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trade_count BIGINT,
vwap DOUBLE, ma7 DOUBLE, ma25 DOUBLE, ma99 DOUBLE, rsi_14 DOUBLE, macd DOUBLE,
macd_signal DOUBLE, macd_hist DOUBLE, bb_upper DOUBLE, bb_lower DOUBLE, atr_14 DOUBLE,
price_change_pct DOUBLE, volume_ratio DOUBLE, candle_pattern STRING, price_rank INT,
partition_date DATE, aggregated_at TIMESTAMP, name STRING, base_asset STRING,
consensus STRING, cmc_rank INT
"""

CONDITIONS = "ARRAY<STRUCT<field: STRING, operator: STRING, value: STRING>>"

RULE = f"""
rule_id STRING, user_id STRING, symbol STRING, timeframe STRING, conditions {CONDITIONS},
logic STRING, action STRING, notification_channels ARRAY<STRING>, email_address STRING,
webhook_url STRING, cooldown_seconds INT, is_active BOOLEAN, created_at TIMESTAMP,
updated_at TIMESTAMP, last_triggered_at TIMESTAMP, trigger_count INT
"""

ALERT_EVENT = """
alert_id STRING, rule_id STRING, user_id STRING, symbol STRING, timeframe STRING,
action STRING, triggered_at TIMESTAMP, close_price DOUBLE, rsi_14 DOUBLE, macd DOUBLE,
volume_ratio DOUBLE, candle_pattern STRING, message STRING
"""
ALERT_COLUMNS = (
    "alert_id", "rule_id", "user_id", "symbol", "timeframe", "action", "triggered_at",
    "close_price", "rsi_14", "macd", "volume_ratio", "candle_pattern", "message",
)
