import pytest
from pyspark.sql import functions as F

from barsmith.functions.conditions import (
    condition_met, condition_reason, field_values, prepared_conditions, rule_met,
)
from barsmith.schemas import CONDITIONS

BAR = dict(close=37050.0, rsi_14=28.5, macd=-50.0, volume_ratio=2.1, candle_pattern="HAMMER",
           prev_close=36000.0, prev_rsi_14=31.0, prev_macd=None)
SCHEMA = ("close DOUBLE, rsi_14 DOUBLE, macd DOUBLE, volume_ratio DOUBLE, candle_pattern STRING, "
          f"prev_close DOUBLE, prev_rsi_14 DOUBLE, prev_macd DOUBLE, conditions {CONDITIONS}, logic STRING")


def evaluate(spark, conditions, logic="AND", **changes):
    bar = {**BAR, **changes}
    df = spark.createDataFrame([(*[bar[k] for k in BAR], conditions, logic)], SCHEMA)
    now, before = field_values(df.columns), field_values(df.columns, "prev_")
    df = df.withColumn("p", prepared_conditions(F.col("conditions")))
    row = df.select(
        rule_met(F.col("p"), F.col("logic"), now, before).alias("met"),
        F.transform("p", lambda c: condition_met(c, now, before)).alias("each"),
        F.transform("p", lambda c: condition_reason(c, now, before, F.col("candle_pattern"))).alias("why"),
    ).first()
    return row.met, row.each, row.why


def test_every_operator(spark):
    cases = [
        ("volume_ratio", ">", "1.5", True), ("volume_ratio", ">", "5", False),
        ("rsi_14", "<", "30", True), ("rsi_14", "<=", "28.5", True), ("rsi_14", ">=", "28.6", False),
        ("close", "==", "37050", True), ("close", "!=", "37050", False),
        ("close", "!=", "abc", True), ("close", "==", "abc", False), ("close", ">", "abc", False),
        ("candle_pattern", "==", "HAMMER", True), ("candle_pattern", "==", "hammer", True),
        ("candle_pattern", "!=", "DOJI", True), ("candle_pattern", ">", "1", False),
        ("rsi_14", "crosses_below", "30", True), ("rsi_14", "crosses_above", "30", False),
        ("close", "crosses_above", "37000", True), ("close", "crosses_above", "35000", False),
        ("macd", "crosses_above", "-60", False), ("rsi_14", "between", "25", False),
        ("mood", ">", "1", False), ("vwap", ">", "0", False),
    ]
    _, each, _ = evaluate(spark, [c[:3] for c in cases])
    wrong = [(c, got) for c, got in zip(cases, each) if got != c[3]]
    assert not wrong


@pytest.mark.parametrize("logic, rsi, want", [
    ("AND", 28.5, True), ("AND", 55.0, False), ("OR", 55.0, True), ("XOR", 28.5, False),
])
def test_logic(spark, logic, rsi, want):
    conditions = [("rsi_14", "<", "30"), ("volume_ratio", ">", "1.5")]
    assert evaluate(spark, conditions, logic, rsi_14=rsi)[0] is want


def test_no_conditions_never_match(spark):
    assert evaluate(spark, [])[0] is False
    assert evaluate(spark, [], "OR")[0] is False


def test_reasons(spark):
    _, _, why = evaluate(
        spark,
        [("rsi_14", "<", "30"), ("candle_pattern", "==", "DOJI"), ("macd", "crosses_above", "0"),
         ("close", "between", "1"), ("vwap", ">", "1")],
    )
    assert why == [
        "rsi_14 < 30 → ✓ (current=28.5)", "candle_pattern == DOJI → ✗ (current=HAMMER)",
        "No previous data for macd", "Unknown operator: between", "vwap is None",
    ]


def test_null_field_is_not_met(spark):
    assert evaluate(spark, [("rsi_14", "<", "30")], rsi_14=None)[0] is False
    assert evaluate(spark, [("candle_pattern", "!=", "DOJI")], candle_pattern=None)[0] is False
