"""Time the headline queries at one scale; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barsmith.plans.queries import QUERIES  # noqa: E402
from barsmith.session import build_session  # noqa: E402

HEADLINE = (
    "candles_1m", "parse_kline_messages", "parse_trade_messages", "route_messages",
    "silver_dedup", "silver_full", "macd_ema", "rsi_14_wilder", "resample_all", "vwap",
    "gold_upsert", "price_rank", "cumulative_volume", "latest_n_per_key", "alerts_triggered",
    "rules_matched", "rule_history", "rule_trigger_stats", "dispatch_rows", "alert_events_valid",
    "candle_gaps", "backfill_ranges", "supplier_candles_1d", "supplier_indicators",
    "supplier_metadata", "minimum_slice",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries, median of warm runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
