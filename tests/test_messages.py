import json

import pytest
from pyspark.sql import functions as F

from barsmith.sources import messages as m

KLINE = {"e": "kline", "E": 1706500801234, "k": {
    "t": 1706500800000, "T": 1706500859999, "s": "AAAUSDT", "i": "1m", "o": "7.10", "h": "7.90",
    "l": "6.80", "c": "7.35", "v": "64.5", "q": "471.25", "n": 17, "V": "30.5", "Q": "222.75", "x": True}}
TRADE = {"e": "trade", "E": 1706500805000, "s": "AAAUSDT", "t": 41, "p": "7.25", "q": "3.5",
         "b": 8, "a": 9, "T": 1706500805000, "m": False}
BOOK = {"u": 77, "s": "AAAUSDT", "b": "7.20", "B": "4.0", "a": "7.95", "A": "6.5"}


def feed(spark, *docs):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return m.unwrapped(spark.createDataFrame([(t,) for t in texts], "value STRING"))


def without(doc, key):
    return {k: v for k, v in doc.items() if k != key}


def test_kline(spark):
    bad_close = {**KLINE, "k": {**KLINE["k"], "c": "seven"}}
    rows = m.kline_candles(feed(
        spark, KLINE, {"e": "kline", "E": 123}, bad_close, {**KLINE, "k": without(KLINE["k"], "x")},
        "{broken",
    )).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.symbol, r.close, r.volume, r.trade_count, r.is_closed) == ("AAAUSDT", 7.35, 64.5, 17, True)
    assert (r.taker_buy_base_vol, r.quote_volume, r.source) == (30.5, 471.25, "websocket")
    assert str(r.partition_date) == "2024-01-29"


def test_trade(spark):
    rows = m.trade_ticks(feed(
        spark, TRADE, {"e": "trade"}, {**TRADE, "p": "x"}, {**TRADE, "T": 0, "t": 2},
        {**without(without(TRADE, "T"), "b"), "t": 3}, {**TRADE, "E": "bad"}, {**TRADE, "T": "bad"},
    )).orderBy("trade_id").collect()
    assert [r.trade_id for r in rows] == [2, 3, 41]
    assert all(r.trade_time == r.event_time for r in rows)
    assert rows[1].buyer_order_id is None and rows[2].is_buyer_maker is False


def test_book(spark):
    got = m.with_spread(m.book_rows(feed(spark, BOOK, without(BOOK, "A"), {**BOOK, "b": "?"}))).collect()
    assert len(got) == 1 and got[0].spread == 0.75 and got[0].best_bid_qty == 4.0


def test_rest(spark):
    row = [1706500800000, "7.10", "7.90", "6.80", "7.35", "64.5", 1706500859999, "471.25", 17, "30.5", "222.75", "0"]
    data = [("AAAUSDT", "1m", json.dumps(row)), ("AAAUSDT", "1m", json.dumps(row[:4])), ("AAAUSDT", "1m", "?")]
    rows = m.rest_candles(spark.createDataFrame(data, "symbol STRING, interval STRING, value STRING")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.close, r.volume, r.trade_count, r.source, r.is_closed) == (7.35, 64.5, 17, "rest", True)
    assert r.event_time == r.open_time and r.taker_buy_quote_vol == 222.75


def test_routes(spark):
    docs = [KLINE, {"stream": "x", "data": TRADE}, BOOK, {**BOOK, "e": "bookTicker"}, {"e": "ping"},
            "{broken", {"e": "kline"}, {**TRADE, "E": "bad"}, {**TRADE, "p": None}, {**BOOK, "A": "?"},
            {**KLINE, "k": {**KLINE["k"], "h": "tall"}}]
    texts = spark.createDataFrame(
        [(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value STRING")
    routed = m.routed(texts)
    got = sorted((r.route, r.key) for r in routed.collect())
    # What does not parse is not routed either.
    assert got == [("book", "AAAUSDT"), ("book", "AAAUSDT"), ("candles", "AAAUSDT"), ("ticks", "AAAUSDT")]
    assert m.trade_ticks(routed.filter("route = 'ticks'")).count() == 1


def test_candle_messages_round_trip(spark, make_candles):
    source = make_candles([("AAA", 0, 10.0), ("AAA", 1, None)])
    sent = m.candle_messages(source).withColumn("timestamp", F.current_timestamp())
    bad = spark.createDataFrame([("AAA", "{oops")], "key STRING, value STRING").withColumn(
        "timestamp", F.current_timestamp())
    back = m.parsed_candles(sent.unionByName(bad))
    assert back.count() == 3 and back.filter("close = 10.0 and volume = 10.0").count() == 1
    assert back.filter("symbol is null").count() == 1


def test_symbol_partition(spark):
    names = ["BTCUSDT", "XRPUSDT", "DOGEUSDT"]
    df = spark.createDataFrame([(n,) for n in names], "symbol STRING")
    got = {r.symbol: r.p for r in df.withColumn("p", m.symbol_partition(F.col("symbol"))).collect()}
    assert got["BTCUSDT"] == 0 and got["XRPUSDT"] == 4 and 0 <= got["DOGEUSDT"] < 5


def test_unsupported_symbol_raises():
    assert m.require_supported(["btcusdt"]) == ["BTCUSDT"]
    with pytest.raises(ValueError, match="Unsupported symbols"):
        m.require_supported(["INVALID999"])
