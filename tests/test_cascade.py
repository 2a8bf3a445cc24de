"""Bars folded through the finest timeframe equal bars folded from the candles themselves."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from barsmith.operators import resample
from barsmith.vocabulary import BAR_TIMEFRAMES

START = datetime(2024, 3, 1, 20, tzinfo=timezone.utc)
SCHEMA = (
    "symbol string, interval string, open_time timestamp, open double, high double, low double, close double,"
    "volume double, quote_volume double, trade_count bigint, ma7 double, rsi_14 double, candle_pattern string"
)


def candles(spark, n=700):
    rng = random.Random(11)

    def value():
        return None if rng.random() < 0.2 else float(rng.randrange(1000))

    rows = []
    for symbol in ("A", "B", None):
        for k in range(n):
            if rng.random() < 0.6:
                rows.append((
                    symbol, rng.choice(["1m", "1m", "1m", "5m"]), START + timedelta(minutes=k), *[value() for _ in range(6)],
                    rng.randrange(9), value(), value(), rng.choice(["doji", "hammer", None])))
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_timeframes_at_once_equal_each_alone(spark):
    silver = candles(spark)
    together = resample.resample(silver)
    for timeframe in BAR_TIMEFRAMES:
        # One timeframe has nothing to nest in: its candles are folded directly.
        assert rows(together.filter(F.col("timeframe") == timeframe)) == rows(resample.resample(silver, (timeframe,)))


def test_timeframes_that_do_not_nest(spark):
    assert resample._nests(BAR_TIMEFRAMES) and resample._nests(("1h", "5m"))
    assert not resample._nests(("5m",)) and not resample._nests(())
    assert rows(resample.resample(candles(spark), ("1d", "15m"))) == rows(
        resample.resample(candles(spark)).filter("timeframe in ('15m', '1d')"))
    assert resample.resample(candles(spark).limit(0)).count() == 0


def test_one_exchange_and_hash_aggregates(spark):
    plan = resample.resample(candles(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 4
