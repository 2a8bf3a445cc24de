from datetime import timedelta

from pyspark.sql import functions as F

from barsmith.operators import gaps, views

from .conftest import utc

AS_OF = utc(2024, 1, 15, 14)


def shown(df, *columns):
    return sorted(tuple(str(v) for v in r) for r in df.select(*columns).collect())


def test_downtime_and_requests(spark, make_candles):
    seen = make_candles([("NOW", 119, 1.0), ("GAP", 0, 1.0), ("OLD", -60 * 72, 1.0)])
    symbols = spark.createDataFrame([(s,) for s in ("NOW", "GAP", "OLD", "NEW")], "symbol STRING")
    found = gaps.downtime_gaps(seen, symbols, AS_OF)
    assert shown(found, "symbol", "gap_start") == [
        ("GAP", "2024-01-15 12:00:00"), ("NEW", "2024-01-12 12:00:00"), ("OLD", "2024-01-12 12:00:00")]
    calls = gaps.backfill_ranges(found)
    old = shown(calls.filter("symbol = 'OLD'"), "request_start", "request_end")
    assert len(old) == 5 and old[0] == ("2024-01-12 12:00:00", "2024-01-13 04:40:00")
    assert old[-1][1] == "2024-01-15 14:00:00"
    cut = gaps.downtime_gaps(seen, symbols, AS_OF, since=utc(2024, 1, 15, 13, 55), max_hours=48)
    assert shown(cut, "symbol", "gap_start") == [
        ("GAP", "2024-01-15 12:00:00"), ("NEW", "2024-01-15 13:55:00"), ("OLD", "2024-01-13 14:00:00")]
    none = gaps.downtime_gaps(seen.limit(0), symbols, AS_OF)
    assert none.count() == 4 and none.filter("gap_start is null").count() == 4


def test_missing_days_and_gaps(make_candles):
    day = 60 * 24
    df = make_candles([("A", -3 * day, 1.0), ("A", -3 * day + 1, 1.0), ("A", -3 * day + 5, 1.0), ("A", 0, 1.0)])
    days = gaps.missing_days(df, AS_OF + timedelta(days=1))
    assert shown(days, "day") == [("2024-01-13",), ("2024-01-14",)]
    listed = df.select("symbol").union(df.sparkSession.createDataFrame([("NEW",)], "symbol STRING"))
    more = gaps.missing_days(df, AS_OF + timedelta(days=1), listed)
    assert shown(more, "symbol", "day") == [("A", "2024-01-13"), ("A", "2024-01-14")] + [
        ("NEW", f"2024-01-{d}") for d in (12, 13, 14, 15)]
    holes = gaps.candle_gaps(df)
    assert sorted(r.missing for r in holes.collect()) == [3, 3 * day - 6]
    assert shown(gaps.last_seen(df), "last_open_time") == [("2024-01-15 12:00:00",)]


def test_views(spark):
    rows = [("A", "1h", utc(2024, 1, 1, h), float(c)) for h, c in enumerate((10, 20, 15))] + [("B", "1h", utc(2024, 1, 1), 5.0)]
    bars = spark.createDataFrame(rows, "symbol STRING, timeframe STRING, window_start TIMESTAMP, close DOUBLE")
    got = {r.symbol: r for r in views.latest_bar_change(bars).collect()}
    assert got["A"].change_pct == -25.0 and got["B"].change_pct == 0.0
    series = views.gold_series(bars, "A", "1h", 2)
    assert [r.close for r in series.collect()] == [20.0, 15.0]
    assert series.select(F.date_format("local_start", "HH")).first()[0] == "08"
