"""Keyed tables: replacement by key, states, replays and crashes, and what a batch costs."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barsmith.sources.keyed import KeyedTable, bar_segment, day_segment

from .conftest import utc

SCHEMA = "symbol STRING, timeframe STRING, window_start TIMESTAMP, first_batch INT, close DOUBLE, note STRING"
KEY = ("symbol", "timeframe", "window_start")


def table(path, **options):
    return KeyedTable(str(path / "bars"), SCHEMA, KEY, lambda: bar_segment(2), ("first_batch",), **options)


def bar(symbol, n, batch, close, note="x", timeframe="5m"):
    return (symbol, timeframe, utc(2024, 1, 1) + timedelta(minutes=5 * n), batch, close, note)


def rows_of(df):
    return {r[:3]: r[3:] for r in map(tuple, df.collect())}


def files(path):
    return sorted(str(f.relative_to(path)) for f in Path(path).rglob("*.parquet"))


def test_rows_are_replaced_by_key_and_replays_change_nothing(spark, tmp_path):
    bars, want, walk = table(tmp_path), {}, random.Random(1)
    for batch in range(6):
        # New bars, revised ones, and some that are far behind.
        new = {b[:3]: b for b in (bar(s, n, batch, walk.random(), None if n % 3 else "n") for s in "ABC"
                                  for n in (batch * 40 + walk.randrange(60), batch * 40, walk.randrange(50)))}
        df = spark.createDataFrame(list(new.values()), SCHEMA)
        bars.apply(df, batch)
        for k, b in new.items():
            want[k] = (want[k][0] if k in want else b[3], *b[4:])
        assert {k[0] + str(k[2]): v for k, v in rows_of(bars.read(spark)).items()} == {
            k[0] + str(k[2].replace(tzinfo=None)): v for k, v in want.items()}
        before = files(tmp_path)
        assert bars.apply(df.withColumn("close", F.lit(-1.0)), batch) == [] and files(tmp_path) == before


def test_untouched_segments_keep_their_files(spark, tmp_path):
    bars = table(tmp_path)
    bars.apply(spark.createDataFrame([bar(s, n, 0, 1.0) for s in "ABCDEFGH" for n in range(0, 960, 10)], SCHEMA), 0)
    first = bars.manifest(spark)
    touched = bars.apply(spark.createDataFrame([bar("A", 500, 1, 2.0)], SCHEMA), 1)
    second = bars.manifest(spark)
    assert len(touched) == 1 and len(first) == 20
    assert {s for s in first if first[s] != second[s]} == set(touched)


def test_a_crash_before_the_manifest_leaves_the_last_state(spark, tmp_path, monkeypatch):
    bars = table(tmp_path)
    bars.apply(spark.createDataFrame([bar("A", 0, 0, 1.0)], SCHEMA), 0)
    new = spark.createDataFrame([bar("A", 0, 1, 2.0), bar("B", 0, 1, 3.0)], SCHEMA)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_publish", crash)
        with pytest.raises(RuntimeError, match="lost"):
            bars.apply(new, 1)
    assert [r["close"] for r in bars.read(spark).collect()] == [1.0]
    bars.apply(new, 1)
    assert sorted(r["close"] for r in bars.read(spark).collect()) == [2.0, 3.0]
    assert [r["close"] for r in bars.read(spark, before=1).collect()] == [1.0]


def test_cost_of_a_batch_stays_flat(spark, tmp_path):
    """Fifty batches of one symbol's next bars: files read, rows folded and states do not pile up."""
    bars = table(tmp_path)
    listed, written = [], []
    for batch in range(50):
        bars.apply(spark.createDataFrame([bar("A", 4 * batch + i, batch, 1.0) for i in range(6)], SCHEMA).coalesce(1), batch)
        listed.append(len(bars.manifest(spark)))
        folder = next(f for s, f in bars.manifest(spark).items() if f"batch_id={batch}/" in f)
        written.append(spark.read.parquet(f"{bars.path}/{folder}").count())
    assert max(listed) == -(-202 // 96) and max(written) <= 96
    assert len(bars.states(spark)) == 3 and bars.read(spark).count() == 202
    # Of older batches only the folders that a state names are left.
    assert len(files(tmp_path)) <= 3 + 3 * max(listed)


def test_empty_batches_and_null_segments(spark, tmp_path):
    alerts = KeyedTable(str(tmp_path / "alerts"), "alert_id STRING, at TIMESTAMP", ("alert_id",), lambda: day_segment("at"))
    assert alerts.read(spark).count() == 0 and alerts.states(spark) == []
    alerts.apply(spark.createDataFrame([], "alert_id STRING, at TIMESTAMP"), 0)
    alerts.apply(spark.createDataFrame([("a", None), ("b", utc(2024, 1, 2))], "alert_id STRING, at TIMESTAMP"), 1)
    assert {r["alert_id"] for r in alerts.read(spark).collect()} == {"a", "b"}
    assert set(alerts.manifest(spark)) == {"none", "20240102"}
    assert {r["alert_id"] for r in alerts.read(spark, wanted=lambda s: s > "2024" and s < "3").collect()} == {"b"}
