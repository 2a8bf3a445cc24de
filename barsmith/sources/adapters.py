"""The star-schema test tables read as market data.

``events`` are trades, ``lineitem`` are daily trades of many instruments, ``customer`` owns
alert rules and ``orders`` are alert events. Everything is computed by Spark from the whole
table, so it grows with it.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candles import ticks_to_candles
from ..schemas import ALERT_COLUMNS

# Event types take the place of exchange symbols. The last has rules but no trades, and
# "view" is left out of the dimension.
SYMBOLS = ("click", "error", "purchase", "signup", "view", "refund")
INFO = (
    ("click", "Click", "CLK", "Proof-of-Work", 1),
    ("error", "Error", "ERR", "Proof-of-Stake", 2),
    ("purchase", "Purchase", "PUR", "BNB Chain", 3),
    ("signup", "Signup", "SGN", "PoH+PoS", 4),
)
TIMEFRAMES = ("5m", "15m", "1h", "4h", "1d")
# Stamps that stand for the time of a run.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
INGESTED_AT = datetime(2024, 1, 31, 0, 0, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_after(times: DataFrame, column: str) -> datetime:
    """Midnight after the latest time of a table."""
    last = times.agg(F.max(F.col(column).cast("timestamp")).alias("last")).select(
        F.unix_seconds(F.date_trunc("day", "last"))).first()[0]
    return datetime.fromtimestamp(last or 0, timezone.utc) + timedelta(days=1)


def events_end(spark: SparkSession, sf_dir: str) -> datetime:
    return day_after(table(spark, sf_dir, "events"), "ts")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        at.alias("event_time"),
        at.alias("ingest_time"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("user_id").alias("buyer_order_id"),
        F.lit(None).cast("bigint").alias("seller_order_id"),
        at.alias("trade_time"),
        # Time, then id: digits of one decimal, as in supplier_ticks.
        (F.unix_micros(at).cast("decimal(20,0)") * F.lit(10**13).cast("decimal(14,0)") + F.col("event_id"))
        .cast("decimal(38,0)").alias("sequence"),
        (F.pmod(F.col("user_id"), F.lit(2)) == 1).alias("is_buyer_maker"),
        F.lit("ticks").alias("source"),
    )


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_candles(ticks(spark, sf_dir), order="sequence")


def candle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each candle as published: half-way and still open, closed, and fetched once more."""
    trades = ticks(spark, sf_dir)
    half = ticks_to_candles(trades.filter(F.second("trade_time") < 30), order="sequence").withColumn(
        "is_closed", F.lit(False)
    )
    closed = ticks_to_candles(trades, order="sequence")
    again = closed.withColumns({"event_time": F.col("open_time"), "source": F.lit("rest")})
    return half.unionByName(closed).unionByName(again)


def supplier_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of their supplier, ordered within the day by order, line and part.

    The three are digits of one decimal, which holds any keys and stays in a hash aggregate.
    """
    day = F.col("l_shipdate").cast("timestamp")
    line = F.col("l_orderkey").cast("decimal(20,0)") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        day.alias("trade_time"),
        day.alias("ingest_time"),
        (line.cast("decimal(20,0)") * F.lit(10**13).cast("decimal(14,0)") + F.col("l_partkey"))
        .cast("decimal(38,0)").alias("sequence"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
    )


def supplier_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_candles(supplier_ticks(spark, sf_dir), "1d", 86_400, "sequence")


def supplier_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("symbol"),
            F.col("s_name").alias("name"), F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
        )
    )


def symbol_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(INFO), "symbol STRING, name STRING, base_asset STRING, consensus STRING, cmc_rank INT"
    )


# ---- messages ----------------------------------------------------------------------------


def _millis(at: str) -> Column:
    return F.unix_millis(at)


def kline_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle versions as exchange messages. Candles of one trade are broken: those of
    errors carry a text close, those of views lack the candle member."""
    text = {
        "o": "open", "h": "high", "l": "low", "v": "volume", "q": "quote_volume",
        "V": "taker_buy_base_vol", "Q": "taker_buy_quote_vol",
    }
    lone = F.col("trade_count") == 1
    close = F.when(lone & (F.col("symbol") == "error"), "n/a").otherwise(
        F.col("close").cast("string")
    )
    candle = F.struct(
        _millis("open_time").alias("t"), _millis("close_time").alias("T"),
        F.col("symbol").alias("s"), F.col("interval").alias("i"), close.alias("c"),
        *[F.col(column).cast("string").alias(key) for key, column in text.items()],
        F.col("trade_count").alias("n"), F.col("is_closed").alias("x"),
    )
    body = F.to_json(F.struct(
        F.lit("kline").alias("e"), _millis("event_time").alias("E"),
        F.when(~(lone & (F.col("symbol") == "view")), candle).alias("k"),
    ))
    return candle_versions(spark, sf_dir).filter("source = 'ticks'").select(body.alias("value"))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as exchange messages inside an envelope. A quantity of 0 gives trade time 0, one of
    1 none, one of 2 and 3 a trade or event time that is no number; a price under 1 is text that
    is no number, and clicks of quantity 99 have no price."""
    price = F.when(F.col("price") < 1, "n/a").otherwise(F.col("price").cast("string"))
    no_price = (F.col("symbol") == "click") & (F.col("quantity") == 99)
    inner = F.struct(
        F.lit("trade").alias("e"),
        F.when(F.col("quantity") == 3, "bad").otherwise(_millis("event_time").cast("string")).alias("E"),
        F.col("symbol").alias("s"), F.col("trade_id").alias("t"), F.when(~no_price, price).alias("p"),
        F.col("quantity").cast("string").alias("q"), F.col("buyer_order_id").alias("b"),
        F.when(F.col("quantity") == 0, "0").when(F.col("quantity") == 2, "soon")
        .when(F.col("quantity") != 1, _millis("trade_time").cast("string")).alias("T"),
        F.col("is_buyer_maker").alias("m"),
    )
    body = F.to_json(F.struct(F.lit("trade").alias("stream"), inner.alias("data")))
    return ticks(spark, sf_dir).select(body.alias("value"))


def book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes around each trade; quantity 0 leaves the ask size out."""
    body = F.to_json(F.struct(
        F.col("trade_id").alias("u"), F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("b"), F.col("quantity").cast("string").alias("B"),
        (F.col("price") + F.col("quantity") / 4 + 1).cast("string").alias("a"),
        F.when(F.col("quantity") > 0, F.col("quantity").cast("string")).alias("A"),
    ))
    return ticks(spark, sf_dir).select(body.alias("value"))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds in one feed, with heartbeats and broken text in it."""
    odd = ticks(spark, sf_dir).select(
        F.when(F.col("is_buyer_maker"), F.to_json(F.struct(F.lit("ping").alias("e"))))
        .otherwise(F.concat(F.lit("{broken "), "symbol"))
        .alias("value")
    )
    feeds = (
        kline_messages(spark, sf_dir), trade_messages(spark, sf_dir),
        book_messages(spark, sf_dir), odd,
    )
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    return union


def rest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles as positional arrays; rows of two trades hold a bad volume."""
    volume = F.when(F.col("trade_count") == 2, "-").otherwise(F.col("volume").cast("string"))
    cells = [
        _millis("open_time"), "open", "high", "low", "close", volume, _millis("close_time"),
        "quote_volume", "trade_count", "taker_buy_base_vol", "taker_buy_quote_vol", F.lit("0"),
    ]
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cells]
    return candles(spark, sf_dir).select(
        "symbol", "interval", F.to_json(F.array(*texts)).alias("value")
    )


# ---- rules and events --------------------------------------------------------------------


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _owner(key: str) -> list[Column]:
    """Columns a rule and its alert events share, from the customer key."""
    k = F.col(key)
    return [
        F.concat(F.lit("rule-"), k).alias("rule_id"),
        F.concat(F.lit("user-"), F.pmod(k, F.lit(25))).alias("user_id"),
        _pick(SYMBOLS, F.pmod(k, F.lit(6))).alias("symbol"),
        _pick(TIMEFRAMES, F.pmod(F.floor(k / 6), F.lit(5))).alias("timeframe"),
    ]


def _condition(field: str, operator: str, value) -> Column:
    text = value.cast("string") if isinstance(value, Column) else F.lit(value)
    return F.struct(
        F.lit(field).alias("field"), F.lit(operator).alias("operator"), text.alias("value")
    )


def _rule_conditions() -> Column:
    """Conditions by market segment; the account balance sets the level."""
    level = F.floor(F.col("c_acctbal") / 1000)
    segment = F.col("c_mktsegment")
    none = F.array().cast("array<struct<field:string,operator:string,value:string>>")
    return (
        F.when(F.col("c_acctbal") < 0, none)
        .when(segment == "BUILDING", F.array(
            _condition("rsi_14", "<", level + 30), _condition("volume_ratio", ">", "1.05"),
        ))
        .when(segment == "MACHINERY", F.array(
            _condition("close", "crosses_above", level * 10), _condition("low", ">=", "1"),
        ))
        .when(segment == "AUTOMOBILE", F.array(
            _condition("candle_pattern", "==", "hammer"), _condition("volume_ratio", ">=", "0.9"),
        ))
        .when(segment == "FURNITURE", F.array(
            _condition("rsi_14", ">", level + 60), _condition("macd_hist", "between", "0"),
            _condition("candle_pattern", "!=", "NEUTRAL"),
        ))
        .otherwise(F.array(
            _condition("macd", "crosses_below", level - 5), _condition("spread", ">", "0"),
            _condition("close", "<=", "0.5"),
        ))
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    any_of = F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")
    created = F.timestamp_seconds(F.lit(1_704_067_200) + k * 60)
    channels = (
        F.when(F.col("c_acctbal") < 2000, F.array(F.lit("email")))
        .when(F.col("c_acctbal") < 6000, F.array(F.lit("email"), F.lit("webhook")))
        .otherwise(F.array(F.lit("webhook")))
    )
    last = F.timestamp_seconds(F.lit(1_706_659_200) - F.pmod(k * 37, F.lit(7200)))
    return table(spark, sf_dir, "customer").select(
        *_owner("c_custkey"),
        _rule_conditions().alias("conditions"),
        F.when(any_of, "OR").otherwise("AND").alias("logic"),
        _pick(("BUY", "SELL", "WATCH"), F.pmod(F.col("c_nationkey"), F.lit(3))).alias("action"),
        channels.alias("notification_channels"),
        F.concat(F.lit("c"), k, F.lit("@example.com")).alias("email_address"),
        F.concat(F.lit("https://hooks.example.com/"), k).alias("webhook_url"),
        (F.pmod(k, F.lit(4)) * 1200 + 600).cast("int").alias("cooldown_seconds"),
        (F.col("c_acctbal") < 9000).alias("is_active"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.when(F.col("c_acctbal") >= 3000, last).alias("last_triggered_at"),
        F.lit(0).alias("trigger_count"),
    )


def rule_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as submitted, with the mistakes users make and the members they leave out."""
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    condition = (
        F.when(nation == 0, F.array(_condition("candle_pattern", "==", "INVALID_PATTERN")))
        .when(nation == 1, F.array(_condition("rsi_14", "<", "low")))
        .when(nation == 2, F.array(_condition("rsi_14", "between", "25")))
        .when(nation == 3, F.array(_condition("mood", ">", "1")))
        .when(nation == 4, F.array(_condition("candle_pattern", "==", "bullish_engulfing")))
        .when(nation == 5, F.array_repeat(_condition("close", ">", "5"), 11))
        .otherwise(_rule_conditions())
    )
    both = F.array(F.lit("email"), F.lit("webhook"))
    # Nation 16 submits each rule twice without an id; the two differ by channel only.
    variants = F.when(nation == 16, F.array(F.array(F.lit("email")), F.array(F.lit("webhook")))).otherwise(F.array(
        F.when(nation == 8, F.array(F.lit("sms"))).when(nation != 15, both)))
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").withColumn("_channels", F.explode(variants)).select(
        F.when(nation != 16, F.concat(F.lit("new-"), key)).alias("rule_id"), _owner("c_custkey")[1],
        F.initcap(_pick(SYMBOLS, F.pmod(F.col("c_custkey"), F.lit(6)))).alias("symbol"),
        F.when(nation == 6, "2h").otherwise("1h").alias("timeframe"),
        condition.alias("conditions"),
        F.when(nation == 7, "XOR").when(nation != 14, "AND").alias("logic"),
        F.when(nation == 9, "HOLD").otherwise("BUY").alias("action"),
        F.col("_channels").alias("notification_channels"),
        F.when(nation == 10, "nobody").otherwise("a@example.com").alias("email_address"),
        F.when(nation == 11, "").when(nation != 12, "https://h.example.com").alias("webhook_url"),
        F.when(nation != 13, F.floor(balance * 10).cast("int")).alias("cooldown_seconds"),
        F.lit(True).alias("is_active"),
    )


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as alert events of their customer's rule."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    at = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod(key, F.lit(86_400))
    pattern = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "HAMMER")
        .when(F.col("o_orderpriority") == "2-HIGH", "DOJI")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "BULLISH")
    )
    action = (
        F.when(F.col("o_orderstatus") == "P", "BUY")
        .when(F.col("o_orderstatus") == "F", "SELL")
        .otherwise("WATCH")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("alert-"), key).alias("alert_id"),
        *_owner("o_custkey"),
        action.alias("action"),
        F.timestamp_seconds(at).alias("triggered_at"),
        F.col("o_totalprice").alias("close_price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.pmod(customer, F.lit(101)).cast("double"))
        .alias("rsi_14"),
        ((F.pmod(key, F.lit(2001)) - 1000) / 100.0).alias("macd"),
        (F.pmod(customer, F.lit(500)) / 100.0).alias("volume_ratio"),
        pattern.alias("candle_pattern"),
        F.col("o_orderpriority").alias("message"),
    ).select(*ALERT_COLUMNS)


def alert_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert events as JSON; urgent purchases are broken text and low sales lack the user."""
    whole = F.to_json(F.struct(*ALERT_COLUMNS))
    partial = F.to_json(F.struct(*[c for c in ALERT_COLUMNS if c != "user_id"]))
    broken = (F.col("action") == "BUY") & (F.col("message") == "1-URGENT")
    lacking = (F.col("action") == "SELL") & (F.col("message") == "5-LOW")
    return alert_events(spark, sf_dir).select(
        F.when(broken, F.concat(F.lit("not json "), "alert_id"))
        .when(lacking, partial)
        .otherwise(whole)
        .alias("value")
    )
