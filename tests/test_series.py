"""Split series must equal whole ones, whatever the gaps and however hot the key."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barsmith.operators import candles, indicators
from barsmith.operators.gaps import candle_gaps
from barsmith.operators.series import CONTEXT, SEGMENT, running_sum, with_context


def walk(count, gap, seed):
    rng, price, at, rows = random.Random(seed), 50.0, 0, []
    for _ in range(count):
        price = max(1.0, round(price + rng.uniform(-2, 2), 2))
        rows.append((at, price))
        at += rng.choice(gap)
    return rows


@pytest.fixture(scope="module")
def clean(make_candles):
    """One key with most rows, one with holes far wider than a segment, one of a single row."""
    rows = [("HOT", t, p) for t, p in walk(900, [1], 1)]
    rows += [("THIN", t, p) for t, p in walk(150, [1, 2, 40, 700], 2)]
    rows += [("ONE", 5, 10.0)]
    return candles.clean(make_candles(rows)).persist()


def table(df, columns):
    rows = df.select("symbol", "open_time", *columns).toPandas()
    return rows.sort_values(["symbol", "open_time"]).reset_index(drop=True)


@pytest.mark.parametrize("segment", [16, 64, 256])
def test_segments_change_nothing(clean, segment):
    columns = ["ma7", "ma25", "ma99", "bb_upper", "rsi_14", "macd_signal", "atr_14", "volume_ratio"]
    split = table(indicators.add_indicators(clean, rows=segment), columns)
    whole = table(indicators.add_indicators(clean), columns)
    pd.testing.assert_frame_equal(split, whole, check_exact=False, rtol=1e-12, atol=1e-9)


def test_indicators_match_pandas(clean):
    got = table(indicators.add_indicators(clean, rows=64), ["close", "ma99", "ma25", "bb_lower", "macd", "rsi_14"])
    for _, part in got.groupby("symbol"):
        close = part.close
        assert (part.ma99 - close.rolling(99, 1).mean()).abs().max() < 1e-9
        assert (part.ma25 - close.rolling(25, 1).mean()).abs().max() < 1e-9
        macd = close.rolling(12, 1).mean() - close.rolling(26, 1).mean()
        assert (part.macd - macd).abs().max() < 1e-9
        band = close.rolling(20, 1).mean() - 2 * close.rolling(20, 2).std()
        assert ((part.bb_lower - band).abs() < 1e-9).iloc[1:].all() and pd.isna(part.bb_lower.iloc[0])
        assert part.rsi_14.iloc[0] == 100.0


def test_hot_key_spreads_over_segments(clean):
    parts = with_context(clean, ["symbol", "interval"], "open_time", 60, 98, rows=128)
    sizes = parts.groupBy("symbol", SEGMENT).agg(
        F.count_if(~F.col(CONTEXT)).alias("own"), F.count_if(CONTEXT).alias("context")
    ).toPandas()
    assert sizes.own.max() <= 128 and sizes.context.max() <= 98
    assert sizes[sizes.symbol == "HOT"].shape[0] >= 7
    assert sizes.own.sum() == clean.count()


def test_running_sum(clean):
    got = table(running_sum(clean, ["symbol", "interval"], "open_time", 60, "volume", "total", 32),
                ["volume", "total"])
    want = got.groupby("symbol").volume.cumsum()
    assert (got.total - want).abs().max() < 1e-6


@pytest.mark.parametrize("segment", [32, 1 << 18])
def test_exponential_means_match_pandas(clean, segment):
    macd = table(indicators.macd_ema(clean, rows=segment), ["close", "ema12", "ema26", "macd_signal"])
    rsi = table(indicators.rsi_14_wilder(clean, rows=segment), ["close", "rsi_14_wilder"])
    for symbol, part in macd.groupby("symbol"):
        fast = part.close.ewm(span=12, adjust=False).mean()
        slow = part.close.ewm(span=26, adjust=False).mean()
        signal = (fast - slow).ewm(span=9, adjust=False).mean()
        assert (part.ema12 - fast).abs().max() < 1e-9
        assert (part.ema26 - slow).abs().max() < 1e-9
        assert (part.macd_signal - signal).abs().max() < 1e-9
        other = rsi[rsi.symbol == symbol]
        delta = other.close.diff()
        gain, loss = delta.clip(lower=0), (-delta).clip(lower=0)
        means = [s.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean() for s in (gain, loss)]
        want = 100 - 100 / (1 + means[0] / means[1].replace(0, float("nan")))
        assert (other.rsi_14_wilder.isna() == want.isna()).all()
        assert not (other.rsi_14_wilder - want).abs().max() > 1e-8


def test_gaps_across_segments(clean):
    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert rows(candle_gaps(clean, rows=16)) == rows(candle_gaps(clean))


def test_plain_window_agrees(clean):
    w = Window.partitionBy("symbol", "interval").orderBy("open_time").rowsBetween(-6, 0)
    plain = table(clean.withColumn("m", F.avg("close").over(w)), ["m"])
    ours = table(indicators.add_indicators(clean, [indicators.moving_averages], rows=16), ["ma7"])
    assert (plain.m - ours.ma7).abs().max() < 1e-9
