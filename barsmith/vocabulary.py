"""Fixed values of the data model: names, lengths and limits users' data depends on."""

# Exchange symbols the ingestion accepts, in partition order.
SYMBOLS = ("BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT")

# symbol, name, base_asset, consensus, cmc_rank
SYMBOL_INFO = (
    ("BTCUSDT", "Bitcoin", "BTC", "Proof-of-Work", 1),
    ("ETHUSDT", "Ethereum", "ETH", "Proof-of-Stake", 2),
    ("BNBUSDT", "BNB", "BNB", "BNB Chain", 3),
    ("SOLUSDT", "Solana", "SOL", "PoH+PoS", 4),
    ("XRPUSDT", "XRP", "XRP", "Federated Consensus", 5),
)
SYMBOL_INFO_DDL = "symbol STRING, name STRING, base_asset STRING, consensus STRING, cmc_rank INT"

# Length of each candle interval in seconds.
INTERVAL_SECONDS = {
    "1m": 60, "3m": 180, "5m": 300, "15m": 900, "30m": 1800,
    "1h": 3600, "4h": 14400, "1d": 86400,
}
# Timeframes the bars are resampled to.
BAR_TIMEFRAMES = ("5m", "15m", "1h", "4h", "1d")

ACTIONS = ("BUY", "SELL", "WATCH")
LOGICS = ("AND", "OR")
OPERATORS = (">", "<", ">=", "<=", "==", "!=", "crosses_above", "crosses_below")
CHANNELS = ("email", "webhook")

# Fields a rule condition may name. candle_pattern is text, the others are numbers.
NUMERIC_FIELDS = (
    "close", "open", "high", "low", "volume", "rsi_14", "macd", "macd_signal", "macd_hist",
    "ma7", "ma25", "ma99", "bb_upper", "bb_lower", "atr_14", "volume_ratio",
    "price_change_pct", "vwap",
)
PATTERN_FIELD = "candle_pattern"

# Patterns the classifier returns, then the two a rule may also name.
CANDLE_PATTERNS = ("HAMMER", "SHOOTING_STAR", "DOJI", "BULLISH", "BEARISH", "NEUTRAL")
RULE_PATTERNS = CANDLE_PATTERNS + ("BULLISH_ENGULFING", "BEARISH_ENGULFING")

MIN_CONDITIONS, MAX_CONDITIONS = 1, 10
MIN_COOLDOWN, MAX_COOLDOWN, DEFAULT_COOLDOWN = 60, 86400, 300

# Context rows read before a batch, and rows returned by the views.
SILVER_HISTORY, GOLD_HISTORY = 100, 20
SERIES_ROWS, RECENT_ALERTS, RULE_HISTORY = 300, 50, 50
MAX_PAGE, MAX_RULE_HISTORY = 100, 200

# Backfill planning: shortest gap in seconds, rows per request.
MIN_GAP_SECONDS, REQUEST_ROWS = 120, 1000

DISPLAY_OFFSET_HOURS = 7
ALERT_TOPIC, CANDLE_TOPIC = "alert-events", "raw-ohlcv"
RECORDS_PER_TRIGGER, TRIGGER_INTERVAL, WATERMARK_DELAY = 50_000, "2 minutes", "2 minutes"
