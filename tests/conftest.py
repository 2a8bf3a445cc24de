import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from barsmith import schemas  # noqa: E402
from barsmith.session import build_session  # noqa: E402


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_candles(spark):
    """Candles from (symbol, minute, close) with optional overrides per row."""

    def build(rows, **common):
        made = []
        for symbol, minute, close, *rest in rows:
            changes = {**common, **(rest[0] if rest else {})}
            at = utc(2024, 1, 15, 12) + timedelta(minutes=minute)
            row = {
                "symbol": symbol, "event_time": at, "ingest_time": at + timedelta(minutes=1),
                "open_time": at, "close_time": at + timedelta(seconds=59), "interval": "1m",
                "open": None if close is None else close - 1.0,
                "high": None if close is None else close + 2.0,
                "low": None if close is None else close - 3.0,
                "close": close, "volume": 10.0 + minute % 7, "quote_volume": 100.0,
                "trade_count": 5, "taker_buy_base_vol": 4.0, "taker_buy_quote_vol": 40.0,
                "is_closed": True, "source": "websocket", "partition_date": at.date(),
            }
            row.update(changes)
            made.append(row)
        names = [part.split()[0] for part in schemas.CANDLE.replace("\n", " ").split(",")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in made], schemas.CANDLE)

    return build
