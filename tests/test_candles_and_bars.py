import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barsmith.operators import candles, history, resample
from barsmith.vocabulary import BAR_TIMEFRAMES

from .conftest import utc


def test_clean_drops_bad_rows_and_types_hold(make_candles):
    rows = [("BTC", 0, 37050.0), ("BTC", 1, None), ("ETH", 0, 2205.0), ("ETH", 1, -100.0),
            ("ETH", 2, 5.0, {"volume": -1.0}), ("ETH", 3, 5.0, {"high": None}),
            ("ETH", 4, 5.0, {"high": 1.0, "low": 2.0}), ("ETH", 5, 5.0, {"volume": None})]
    got = candles.clean(make_candles(rows))
    assert sorted((r.symbol, r.close) for r in got.collect()) == [("BTC", 37050.0), ("ETH", 2205.0)]
    kinds = dict(got.dtypes)
    assert kinds["partition_date"] == "date"
    assert all(kinds[c] == "double" for c in ("open", "high", "low", "close", "volume"))


def test_close_time_falls_back_to_event_time(make_candles):
    got = candles.clean(make_candles([("BTC", 0, 5.0)]).drop("close_time")).first()
    assert got.close_time == got.open_time


def test_latest_versions(make_candles):
    late = {"ingest_time": utc(2024, 1, 16)}
    rows = [
        ("A", 0, 1.0), ("A", 0, 2.0, late), ("B", 0, 3.0), ("B", 0, 4.0, {**late, "is_closed": False}),
        ("C", 0, 5.0, {"event_time": utc(2024, 1, 17)}), ("C", 0, 6.0, late),
    ]
    got = candles.latest_versions(make_candles(rows))
    assert sorted((r.symbol, r.close) for r in got.collect()) == [("A", 2.0), ("B", 3.0), ("C", 5.0)]


def test_valid_candles_fill_the_date(make_candles):
    rows = [("A", 0, 1.0, {"partition_date": None}), ("A", 1, None), (None, 2, 1.0)]
    got = candles.valid_candles(make_candles(rows)).collect()
    assert len(got) == 1 and str(got[0].partition_date) == "2024-01-15"


@pytest.fixture(scope="module")
def silver(make_candles):
    rows = [(s, i, 37050.0 + i) for s in ("BTCUSDT", "ETHUSDT") for i in range(130)]
    return candles.enrich(candles.clean(make_candles(rows)), utc(2024, 1, 16))


def test_enriched_columns(silver):
    row = silver.filter("symbol = 'BTCUSDT'").orderBy(F.col("open_time").desc()).first()
    assert row.ma7 == pytest.approx(37050 + 129 - 3) and row.rsi_14 == 100.0
    assert row.prev_close == 37050 + 128 and row.volume_ratio is not None
    assert row.candle_pattern is not None and row.processing_time is not None


def test_bars(silver):
    bars = resample.resample(silver).persist()
    assert {r.timeframe for r in bars.select("timeframe").distinct().collect()} == set(BAR_TIMEFRAMES)
    assert bars.filter("high < low").count() == 0
    first = bars.filter("symbol = 'BTCUSDT' and timeframe = '5m'").orderBy("window_start").first()
    assert (first.open, first.close, first.trade_count) == (37049.0, 37054.0, 25)
    assert first.window_end - first.window_start == timedelta(minutes=5)
    assert {"ma99", "macd_hist", "price_change_pct", "candle_pattern"} <= set(bars.columns)
    totals = {(r.timeframe, r.symbol): r.v for r in bars.groupBy("timeframe", "symbol").agg(F.sum("volume").alias("v")).collect()}
    for (_, symbol), volume in totals.items():
        assert volume == pytest.approx(totals[("1d", symbol)])


def test_other_intervals_are_not_counted_twice(silver):
    both = silver.unionByName(silver.withColumn("interval", F.lit("5m")))
    assert resample.resample(both, ("1h",)).agg(F.sum("volume")).first()[0] == pytest.approx(
        silver.agg(F.sum("volume")).first()[0])


def test_gold_columns(spark, silver):
    bars = resample.gold(silver, resample.symbol_info(spark), utc(2024, 1, 16))
    rows = bars.filter("timeframe = '5m'").collect()
    assert all(30000 < r.vwap < 40000 for r in rows)
    assert {r.name for r in rows} == {"Bitcoin", "Ethereum"} and rows[0].aggregated_at is not None
    assert dict(bars.dtypes)["partition_date"] == "date"


def test_ranks_pivot_unpivot(silver):
    bars = resample.add_price_rank(resample.resample(silver, ("1h",)))
    assert {r.price_rank for r in bars.collect()} == {1}
    assert set(resample.pivot_closes(bars).columns) == {"timeframe", "window_start", *(r[0] for r in bars.select("symbol").distinct().collect())}
    wide = resample.pivot_closes(bars, ["BTCUSDT", "ETHUSDT"])
    assert {"window_start", "BTCUSDT", "ETHUSDT"} <= set(wide.columns)
    long = resample.unpivot_metrics(bars)
    names = {r.metric_name for r in long.select("metric_name").distinct().collect()}
    assert {"close", "rsi_14"} <= names and {"metric_name", "metric_value"} <= set(long.columns)


@pytest.mark.parametrize("split_rows", [1, 7, 50, 1000])
def test_ranks_of_split_bars_equal_a_plain_window(spark, split_rows):
    rng = random.Random(2)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, -3.0, 1e300, 5e-324]
    rows = [("1h", hour, f"s{i}", rng.choice([*odd, float(rng.randrange(40)), rng.lognormvariate(5, 4)]))
            for hour, n in ((0, 300), (1, 60), (2, 1)) for i in range(n)]
    rows += [("1h", 3, f"s{i}", 7.0) for i in range(90)] + [(None, 4, "s", 1.0), (None, 4, "t", 2.0)]
    rows += [("1h", 5, f"s{i}", None) for i in range(60)]
    bars = spark.createDataFrame(rows, "timeframe string, h int, symbol string, volume double").selectExpr(
        "timeframe", "timestamp_seconds(3600 * h) as window_start", "symbol", "volume")
    w = Window.partitionBy("timeframe", "window_start").orderBy(F.col("volume").desc())
    want = bars.withColumns({"price_rank": F.rank().over(w), "volume_dense_rank": F.dense_rank().over(w)})
    got = resample.add_volume_dense_rank(resample.add_price_rank(bars, split_rows), split_rows)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_large_bar_is_ranked_in_many_tasks(spark):
    bars = spark.range(20_000).selectExpr(
        "'1h' as timeframe", "timestamp_seconds(0) as window_start", "id as symbol", "exp(id % 9000 / 500) as volume")
    ranged = resample._rank_in_bar(bars, "r", False, 1000)
    ranges = [w for w in ranged._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [rank(" in w]
    assert len(ranges) == 1 and "_part" in ranges[0]
    assert ranged.agg(F.max("r")).first()[0] > 19_990


def test_merge_keeps_first_open(spark):
    rows = [("A", 1, 0, 10.0, 12.0), ("A", 1, 2, 99.0, 15.0), ("A", 1, 1, 50.0, 13.0), ("B", 1, 1, 7.0, 8.0)]
    df = spark.createDataFrame(rows, "k STRING, t INT, batch_id INT, open DOUBLE, high DOUBLE")
    got = history.merged_by_key(df, ["k", "t"], "batch_id", ["open"])
    assert got.columns == ["k", "t", "open", "high"]
    assert sorted(map(tuple, got.collect())) == [("A", 1, 10.0, 15.0), ("B", 1, 7.0, 8.0)]


def test_history_before_batch(make_candles):
    stored = make_candles([("A", i, 1.0 + i) for i in range(20)] + [("Z", i, 1.0) for i in range(5)])
    batch = make_candles([("A", i, 1.0 + i) for i in range(15, 25)])
    keys = ["symbol", "interval"]
    got = history.latest_before(stored, batch, keys, "open_time", 4)
    assert sorted(r.close for r in got.collect()) == [12.0, 13.0, 14.0, 15.0]
    rest = history.history_without_batch(stored, batch, [*keys, "open_time"])
    assert rest.count() == 20
    both = history.union_by_name(batch, rest.drop("quote_volume"))
    assert both.filter("not is_new and quote_volume is null").count() == 20
