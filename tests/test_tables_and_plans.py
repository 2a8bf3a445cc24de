import re

import pytest
from pyspark.sql import functions as F

from barsmith import schemas
from barsmith.operators import candles, indicators, resample
from barsmith.plans.oracles import ORACLES
from barsmith.plans.queries import QUERIES
from barsmith.session import shared_dir
from barsmith.sources import tables

SF = "/root/testdata/sf0.001"


def test_batches_replace_themselves(spark, tmp_path, make_candles):
    path = str(tmp_path / "t")
    assert tables.read_batches(spark, path) is None and tables.latest_batch(spark, path, 9) is None
    first, second = make_candles([("A", 0, 1.0)]), make_candles([("A", 1, 2.0), ("B", 1, 3.0)])
    tables.write_batch(first, path, 0, ["partition_date"])
    tables.write_batch(second, path, 1, ["partition_date"])
    tables.write_batch(second, path, 1, ["partition_date"])
    assert tables.read_batches(spark, path, schema=schemas.CANDLE).count() == 3
    assert tables.read_batches(spark, path, before=1).count() == 1
    assert tables.latest_batch(spark, path, 1) == 0 and tables.latest_batch(spark, path, 9) == 1
    wider = make_candles([("A", 2, 1.0)]).withColumn("extra", F.lit(1))
    tables.write_batch(wider, path, 2, ["partition_date"])
    merged = tables.read_batches(spark, path)
    assert merged.filter("extra is null").count() == 3 and merged.filter("extra = 1").count() == 1


def test_seed_only_once(spark, tmp_path):
    sample = spark.createDataFrame([("r1",)], "rule_id STRING")
    assert tables.seed(spark, sample, str(tmp_path / "rules")) is True
    assert tables.seed(spark, sample, str(tmp_path / "rules")) is False


def test_compaction_and_publish(spark, tmp_path):
    view = spark.createDataFrame([("k", "v")], "key STRING, value STRING")
    tables.compact(spark, view, str(tmp_path / "c"))
    assert tables.read_batches(spark, str(tmp_path / "c")).count() == 1
    with pytest.raises(ValueError):
        tables.compact(spark, view, str(tmp_path / "c"))
    tables.publish(view, "json", path=str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_paths(spark):
    assert tables.layer_path("/b/", "silver", "ohlcv") == "/b/silver/ohlcv"
    assert tables.layer_path("/b", "other", "ohlcv") == "/b/ohlcv"
    assert tables.checkpoint_path("/b", "job") == "/b/checkpoints/job"
    assert shared_dir(spark, "/tmp/x") == (spark.conf.get("spark.checkpoint.dir", None) or "/tmp/x")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_for_all_timeframes(spark, make_candles):
    source = candles.with_pattern(candles.clean(make_candles([("A", 0, 1.0)])))
    text = plan(resample.resample(source))
    assert len(re.findall(r"\bExchange ", text)) == 1
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_limits_apply_before_the_shuffle(make_candles):
    text = plan(candles.latest_versions(make_candles([("A", 0, 1.0)])))
    assert len(re.findall("WindowGroupLimit", text)) == 2


def test_stages_share_one_sort(make_candles):
    text = plan(indicators.add_indicators(candles.clean(make_candles([("A", 0, 1.0)]))))
    # Row-number limit, segments to come, and the indicator windows: one exchange each.
    assert len(re.findall(r"\bExchange ", text)) <= 3


def test_no_python_workers(spark):
    for name, build in QUERIES.items():
        text = plan(build(spark, SF))
        assert not re.search(r"Python|ArrowEval|MapInPandas|FlatMapGroups", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name


def test_scan_reads_needed_columns_only(spark):
    text = QUERIES["unsupported_symbols"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in text


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
