"""Rolling values with the stream's own state against one batch over all candles."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from barsmith.operators.candles import with_pattern
from barsmith.operators.indicators import add_indicators
from barsmith.sources import tables
from barsmith.streaming import rolling

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = (
    "symbol string, interval string, open_time timestamp, open double, high double, low double, close double,"
    "volume double, is_closed boolean"
)


def candle(rng, symbol, k, closed=True):
    price = rng.randrange(100, 200) / 4
    return (symbol, "1m", START + timedelta(minutes=k), price, price + 2, price - 1, price + 1, float(rng.randrange(9)), closed)


def test_split_batches_and_a_restart_equal_one_batch(spark, tmp_path):
    rng, source, base = random.Random(5), str(tmp_path / "in"), str(tmp_path / "lake")
    series = {s: [candle(rng, s, k * gap) for k in range(260)] for s, gap in (("A", 1), ("B", 3))}
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def send(number, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{number}")

    def drain():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
        rolling.start(stream, base, delay="30 days", rows=64, available_now=True).awaitTermination()

    try:
        # Copies, open versions and rows that are not sane change nothing.
        a, b = series["A"], series["B"]
        send(0, [*a[:40], *b[:7], a[3], candle(rng, "A", 40, closed=False), ("A", "1m", START, 1.0, 1.0, 2.0, 1.0, 1.0, True)])
        send(1, [*a[40:150], a[39]])
        drain()
        late = candle(rng, "B", 1)
        send(2, [*a[150:], *b[7:], late])
        drain()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)

    got = tables.read_batches(spark, rolling.values_path(base))
    want = with_pattern(add_indicators(spark.createDataFrame(a + b, SCHEMA).drop("is_closed")))
    columns = want.columns
    shown = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]

    def rows(df):
        return sorted(map(tuple, df.select(*shown).collect()), key=repr)

    assert set(columns) <= set(got.columns)
    assert rows(got) == rows(want)
    left = tables.read_batches(spark, rolling.late_path(base)).select("symbol", "open_time", "close").collect()
    assert [tuple(r) for r in left] == [("B", late[2].replace(tzinfo=None), late[6])]


def test_idle_series_are_forgotten(spark, tmp_path):
    rng, source, base = random.Random(6), str(tmp_path / "in"), str(tmp_path / "lake")
    day = 24 * 60
    parts = [[candle(rng, "A", k) for k in range(5)], [candle(rng, "B", day)], [candle(rng, "B", day + 1), candle(rng, "A", day + 1)]]
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for number, rows in enumerate(parts):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{number}")
            stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
            rolling.start(stream, base, delay="10 minutes", idle=3600, rows=64, available_now=True).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    got = tables.read_batches(spark, rolling.values_path(base))
    last = {r["symbol"]: r["ma7"] for r in got.filter(F.col("open_time") == F.lit(START + timedelta(minutes=day + 1))).collect()}
    # B's mean has both its candles; A starts anew.
    assert last["A"] == parts[2][1][6]
    assert last["B"] == (parts[1][0][6] + parts[2][0][6]) / 2
