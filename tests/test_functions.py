import json

import pytest
from pyspark.sql import functions as F

from barsmith import functions as fn

from .conftest import utc


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i INT, {schema}")
    return [r[0] for r in df.orderBy("_i").select(column).collect()]


def test_candle_pattern(spark):
    cases = [
        ((20.0, 24.0, 16.0, 20.1), "DOJI"),
        ((20.0, 20.6, 12.0, 20.5), "HAMMER"),
        ((20.5, 28.0, 19.9, 20.0), "SHOOTING_STAR"),
        ((20.0, 29.2, 19.8, 29.0), "BULLISH"),
        ((29.0, 29.1, 19.5, 20.0), "BEARISH"),
        ((20.0, 23.0, 18.0, 22.0), "NEUTRAL"),
        ((None, 1.0, 1.0, 1.0), None),
        ((1.0, 1.0, 1.0, None), None),
        ((0.0, 1.0, 0.0, 1.0), None),
        ((5.0, 5.0, 5.0, 5.0), "DOJI"),
    ]
    column = fn.candle_pattern(F.col("o"), F.col("h"), F.col("l"), F.col("c"))
    schema = "o DOUBLE, h DOUBLE, l DOUBLE, c DOUBLE"
    assert values(spark, [c for c, _ in cases], schema, column) == [want for _, want in cases]


def test_true_range_ignores_unknown_previous(spark):
    column = fn.true_range(F.col("h"), F.col("l"), F.col("p"))
    got = values(spark, [(10.0, 8.0, None), (10.0, 8.0, 15.0), (10.0, 8.0, 1.0)],
                 "h DOUBLE, l DOUBLE, p DOUBLE", column)
    assert got == [2.0, 7.0, 9.0]


@pytest.mark.parametrize(
    "rsi, macd, ratio, want",
    [(12.0, 4.5, 1.9, "STRONG"), (64.0, -0.03, 0.4, "MODERATE"), (47.0, 0.0009, 1.5, "WEAK"),
     (None, None, None, "WEAK")],
)
def test_signal_strength(spark, rsi, macd, ratio, want):
    column = fn.signal_strength(F.col("r"), F.col("m"), F.col("v"))
    assert values(spark, [(rsi, macd, ratio)], "r DOUBLE, m DOUBLE, v DOUBLE", column) == [want]


def test_signal_message(spark):
    names = ["symbol", "action", "close", "rsi", "macd", "ratio", "pattern", "rule"]
    schema = ("symbol STRING, action STRING, close DOUBLE, rsi DOUBLE, macd DOUBLE, ratio DOUBLE, "
              "pattern STRING, rule STRING")
    rows = [
        ("AAAUSDT", "SELL", 812.34567, 71.236, None, 1.875, "DOJI", "r9"),
        ("", "BUY", 1.0, 1.0, 1.0, 1.0, None, "r1"), (None, "BUY", 1.0, 1.0, 1.0, 1.0, None, "r1"),
        ("AAAUSDT", "", 1.0, 1.0, 1.0, 1.0, None, "r1"),
    ]
    got = values(spark, rows, schema, fn.signal_message(*[F.col(n) for n in names]))
    assert json.loads(got[0]) == {
        "symbol": "AAAUSDT", "action": "SELL", "close_price": 812.3457, "rsi_14": 71.24,
        "macd": None, "volume_ratio": 1.88, "candle_pattern": "DOJI", "rule_id": "r9",
        "signal_type": "STRONG",
    }
    assert got[1:] == [None, None, None]


def test_pivot_levels(spark):
    column = fn.pivot_levels(F.col("h"), F.col("l"), F.col("c"))
    got = values(spark, [(16.0, 10.0, 13.0), (None, 1.0, 1.0)],
                 "h DOUBLE, l DOUBLE, c DOUBLE", column)
    level = got[0].asDict()
    assert level == {"pivot": 13.0, "r1": 16.0, "r2": 19.0, "s1": 10.0, "s2": 7.0}
    assert got[1] is None


def test_volume_profile(spark):
    column = fn.volume_profile(F.col("h"), F.col("l"), F.col("v"))
    got = values(spark, [(90.0, 70.0, 250.0), (5.0, 5.0, 1.0), (5.0, None, 1.0)],
                 "h DOUBLE, l DOUBLE, v DOUBLE", column)
    assert len(got[0]) == 10 and sum(s.volume for s in got[0]) == pytest.approx(250.0)
    assert all(70 < s.price_level < 90 for s in got[0])
    assert got[1:] == [None, None]


def test_advice(spark):
    schema = "rsi DOUBLE, macd DOUBLE, signal DOUBLE, ratio DOUBLE"
    rows = [(75.0, 1.0, 0.5, 2.0), (25.0, -1.0, 0.5, 1.0), (None, None, 0.5, None)]
    assert values(spark, rows, schema, fn.rsi_advice(F.col("rsi"))) == [
        "SELL / OVERBOUGHT", "BUY / OVERSOLD", "NEUTRAL"]
    assert values(spark, rows, schema, fn.macd_advice(F.col("macd"), F.col("signal"))) == [
        "BULLISH MOMENTUM", "BEARISH MOMENTUM", "NEUTRAL"]
    assert values(spark, rows, schema, fn.volume_surge(F.col("ratio"))) == [
        "HIGH SURGE", "NORMAL", "NORMAL"]


def test_time_functions(spark):
    rows = [("5m", utc(2024, 1, 1, 10, 7, 31)), ("1d", utc(2024, 1, 1, 23, 59)), ("7m", utc(1969, 12, 31, 23))]
    schema = "tf STRING, at TIMESTAMP"
    seconds = fn.interval_seconds(F.col("tf"))
    assert values(spark, rows, schema, seconds) == [300, 86400, None]
    start = F.date_format(fn.bucket_start(F.col("at"), 300), "yyyy-MM-dd HH:mm:ss")
    assert values(spark, rows, schema, start)[0] == "2024-01-01 10:05:00"
    shown = F.date_format(fn.local_time(F.col("at")), "yyyy-MM-dd HH:mm")
    assert values(spark, rows, schema, shown)[0] == "2024-01-01 17:07"
