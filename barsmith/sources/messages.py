"""Exchange messages and candle messages as typed rows.

Exchange JSON has keys that differ by case only (e/E, t/T), which a struct schema cannot hold
apart. Fields are read by ``json_tuple``: one pass over a text for all its members, exact key
names, and NULL for what is missing. A candle message takes three: for the envelope, the body
and the candle in it. Being a generator it also keeps the validity filters from being pushed below
it, where each of them would parse the text again. A message that lacks a required field or has
a bad number gives no row.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CANDLE
from ..vocabulary import SYMBOLS

BODY = "_body"
_CANDLE_NAMES = [part.split()[0] for part in CANDLE.replace("\n", " ").split(",")]


def unwrapped(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the message text without its optional ``data`` envelope."""
    text = F.col(value).cast("string")
    return messages.withColumn(BODY, F.coalesce(F.get_json_object(text, "$.data"), text))


def _with_fields(df: DataFrame, text: str, names: Mapping[str, str]) -> DataFrame:
    """Add JSON members as text columns; ``names`` maps column names to JSON keys."""
    return df.select("*", F.json_tuple(text, *names.values()).alias(*names))


def _millis(column: str) -> Column:
    return F.timestamp_millis(F.col(column).try_cast("bigint"))


def _number(column: str) -> Column:
    return F.col(column).try_cast("double")


def _complete(df: DataFrame, columns) -> DataFrame:
    return df.filter(reduce(lambda a, c: a & F.col(c).isNotNull(), columns, F.lit(True)))


def _now(ingested_at: datetime | None) -> Column:
    now = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return now.cast("timestamp")


#: Members of a candle message: texts, then those that must be numbers.
KLINE_TEXTS, KLINE_NUMBERS = ("s", "i", "x"), ("t", "T", "n", "o", "h", "l", "c", "v", "q", "V", "Q")


def _good_times() -> Column:
    """Whether a trade's times are numbers, or absent; text in their place spoils the message."""
    fine = F.lit(True)
    for column in ("_event", "_traded"):
        fine = fine & (F.col(column).isNull() | F.col(column).try_cast("bigint").isNotNull())
    return fine


def routed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Unwrapped messages with a route (candles, ticks, book) and a key.

    Others are dropped, and so are those that their route's parser would drop.
    """
    fields = {
        "_kind": "e", "_event": "E", "_symbol": "s", "_bid": "b", "_ask": "a", "_candle": "k", "_id": "u",
        "_bid_qty": "B", "_ask_qty": "A", "_price": "p", "_quantity": "q", "_traded": "T",
    }
    outer = _with_fields(unwrapped(messages, value), BODY, fields)
    # Names by place: Spark takes _t and _T for one.
    names = {c: f"_k{i}" for i, c in enumerate(KLINE_TEXTS + KLINE_NUMBERS)}
    inner = {name: c for c, name in names.items()}
    found = _with_fields(outer, "_candle", inner)
    kind = F.col("_kind")

    def numbers(*columns: str) -> Column:
        return reduce(lambda a, c: a & _number(c).isNotNull(), columns, F.lit(True))

    whole_candle = (
        F.col("_event").try_cast("bigint").isNotNull() & numbers(*(names[c] for c in KLINE_NUMBERS))
        & reduce(lambda a, c: a & F.col(names[c]).isNotNull(), KLINE_TEXTS, F.lit(True))
        & F.col(names["x"]).try_cast("boolean").isNotNull()
    )
    whole_trade = F.col("_symbol").isNotNull() & numbers("_price", "_quantity") & _good_times()
    whole_book = F.col("_symbol").isNotNull() & numbers("_id", "_bid", "_bid_qty", "_ask", "_ask_qty")
    looks_like_book = (
        F.col("_bid").isNotNull() & F.col("_ask").isNotNull() & F.col("_symbol").isNotNull()
    )
    route = (
        F.when(kind == "kline", F.when(whole_candle, "candles"))
        .when(kind == "trade", F.when(whole_trade, "ticks"))
        .when((kind == "bookTicker") | looks_like_book, F.when(whole_book, "book"))
    )
    symbol = F.when(kind == "kline", F.col(names["s"])).otherwise(F.col("_symbol"))
    return (
        found.withColumns({"route": route, "key": F.coalesce(symbol, F.lit("UNKNOWN"))})
        .filter(F.col("route").isNotNull())
        .drop(*fields, *inner)
    )


def kline_candles(unwrapped_rows: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Candles of kline messages."""
    numbers = {
        "open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "quote_volume": "q",
        "taker_buy_base_vol": "V", "taker_buy_quote_vol": "Q",
    }
    outer = _with_fields(unwrapped_rows.select(BODY), BODY, {"_event": "E", "_candle": "k"})
    inner = _with_fields(outer, "_candle", {
        "symbol": "s", "interval": "i", "_open": "t", "_close": "T", "_count": "n",
        "_closed": "x", **numbers,
    })
    rows = inner.select(
        "symbol",
        _millis("_event").alias("event_time"),
        _now(ingested_at).alias("ingest_time"),
        _millis("_open").alias("open_time"),
        _millis("_close").alias("close_time"),
        "interval",
        *[_number(name).alias(name) for name in numbers],
        F.col("_count").try_cast("int").alias("trade_count"),
        F.col("_closed").try_cast("boolean").alias("is_closed"),
        F.lit("websocket").alias("source"),
        F.to_date(_millis("_open")).alias("partition_date"),
    )
    optional = ("ingest_time", "source", "partition_date")
    required = [c for c in _CANDLE_NAMES if c not in optional]
    return _complete(rows, required).select(*_CANDLE_NAMES)


def trade_ticks(unwrapped_rows: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Ticks of trade messages; an absent or zero trade time falls back to the event time."""
    found = _with_fields(unwrapped_rows.select(BODY), BODY, {
        "symbol": "s", "_event": "E", "_traded": "T", "_id": "t", "_price": "p", "_quantity": "q",
        "_buyer": "b", "_seller": "a", "_maker": "m",
    }).filter(_good_times())
    traded = F.coalesce(F.nullif(F.col("_traded").try_cast("bigint"), F.lit(0)),
                        F.col("_event").try_cast("bigint"))
    rows = found.select(
        "symbol",
        _millis("_event").alias("event_time"),
        _now(ingested_at).alias("ingest_time"),
        F.col("_id").try_cast("bigint").alias("trade_id"),
        _number("_price").alias("price"),
        _number("_quantity").alias("quantity"),
        F.col("_buyer").try_cast("bigint").alias("buyer_order_id"),
        F.col("_seller").try_cast("bigint").alias("seller_order_id"),
        F.timestamp_millis(traded).alias("trade_time"),
        F.col("_maker").try_cast("boolean").alias("is_buyer_maker"),
        F.lit("websocket").alias("source"),
    )
    return _complete(rows, ("symbol", "price", "quantity"))


def book_rows(unwrapped_rows: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Best bid and ask of book messages."""
    found = _with_fields(unwrapped_rows.select(BODY), BODY, {
        "symbol": "s", "_id": "u", "_bid": "b", "_bid_qty": "B", "_ask": "a", "_ask_qty": "A",
    })
    rows = found.select(
        "symbol",
        _now(ingested_at).alias("ingest_time"),
        F.col("_id").try_cast("bigint").alias("update_id"),
        _number("_bid").alias("best_bid"),
        _number("_bid_qty").alias("best_bid_qty"),
        _number("_ask").alias("best_ask"),
        _number("_ask_qty").alias("best_ask_qty"),
        F.lit("websocket").alias("source"),
    )
    required = ("symbol", "update_id", "best_bid", "best_bid_qty", "best_ask", "best_ask_qty")
    return _complete(rows, required)


def with_spread(book: DataFrame) -> DataFrame:
    return book.withColumn("spread", F.col("best_ask") - F.col("best_bid"))


def rest_candles(
    rows: DataFrame, value: str = "value", ingested_at: datetime | None = None
) -> DataFrame:
    """Candles of positional arrays; ``rows`` names the symbol and interval of each array.

    Array order: open time, open, high, low, close, volume, close time, quote volume, trade
    count, taker base volume, taker quote volume, unused.
    """
    cells = F.from_json(F.col(value), "array<string>")
    parts = rows.withColumn("_row", F.explode(F.array(cells)))

    def number(i: int, kind: str = "double") -> Column:
        return F.get("_row", F.lit(i)).try_cast(kind)

    opened = F.timestamp_millis(number(0, "bigint"))
    candles = parts.select(
        "symbol",
        opened.alias("event_time"),
        _now(ingested_at).alias("ingest_time"),
        opened.alias("open_time"),
        F.timestamp_millis(number(6, "bigint")).alias("close_time"),
        "interval",
        *[
            number(i).alias(name)
            for i, name in enumerate(("open", "high", "low", "close", "volume"), start=1)
        ],
        number(7).alias("quote_volume"),
        number(8, "int").alias("trade_count"),
        number(9).alias("taker_buy_base_vol"),
        number(10).alias("taker_buy_quote_vol"),
        F.lit(True).alias("is_closed"),
        F.lit("rest").alias("source"),
        F.to_date(opened).alias("partition_date"),
    )
    optional = ("ingest_time", "symbol", "interval", "is_closed", "source")
    return _complete(candles, [c for c in _CANDLE_NAMES if c not in optional])


def candle_messages(candles: DataFrame) -> DataFrame:
    """Candles as key and JSON value, the form the candle topic carries."""
    return candles.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*_CANDLE_NAMES)).alias("value")
    )


def parsed_candles(messages: DataFrame, with_text: bool = False) -> DataFrame:
    """Candle messages flattened to columns, with the message's own key and timestamp.

    Malformed JSON gives NULL columns, which the validity filter removes. ``with_text`` keeps the
    message's text as ``_kafka_value``.
    """
    text = F.col("value").cast("string")
    return messages.select(
        F.col("key").cast("string").alias("_kafka_key"),
        F.col("timestamp").alias("_kafka_ts"),
        *([text.alias("_kafka_value")] if with_text else []),
        F.inline(F.array(F.from_json(text, CANDLE))),
    )


def supported(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows of the symbols on the list."""
    return df.join(symbols.select("symbol"), "symbol", "left_semi")


def unsupported_symbols(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Symbols that occur but are not on the list."""
    return df.select("symbol").distinct().join(symbols.select("symbol"), "symbol", "left_anti")


def require_supported(symbols, known=SYMBOLS) -> list[str]:
    """Upper-case a job's symbol arguments; an unknown symbol is an error."""
    upper = [s.upper() for s in symbols]
    unknown = sorted(set(upper) - set(known))
    if unknown:
        raise ValueError(f"Unsupported symbols: {unknown}")
    return upper


def symbol_partition(symbol: Column, known=SYMBOLS, partitions: int | None = None) -> Column:
    """Partition number of a symbol: its place in the list, else a stable hash."""
    count = partitions or len(known)
    place = F.array_position(F.array(*[F.lit(s) for s in known]), symbol) - 1
    # The first eight hex digits of the MD5 digest: the same in every process.
    digest = F.conv(F.substring(F.md5(symbol), 1, 8), 16, 10).cast("bigint")
    return F.when(place >= 0, place).otherwise(F.pmod(digest, F.lit(count))).cast("int")
