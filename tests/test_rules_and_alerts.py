import random
from datetime import timedelta

import json

import pytest
from pyspark.sql import functions as F

from barsmith import schemas
from barsmith.functions.conditions import rule_met
from barsmith.operators import alerts, dispatch, resample, rules

from .conftest import utc

BASE = dict(
    rule_id="r1", user_id="u1", symbol="BTCUSDT", timeframe="1h", conditions=[("rsi_14", "<", "30")],
    logic="AND", action="BUY", notification_channels=["email"], email_address="a@example.com",
    webhook_url=None, cooldown_seconds=300, is_active=True, created_at=utc(2024, 1, 1),
    updated_at=utc(2024, 1, 1), last_triggered_at=None, trigger_count=0,
)
AT = utc(2024, 2, 1)


def table(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], schemas.RULE)


def test_violations(spark):
    payloads = table(
        spark, {"rule_id": "ok", "symbol": "btcusdt"},
        {"rule_id": "pattern", "conditions": [("candle_pattern", "==", "INVALID_PATTERN")]},
        {"rule_id": "engulfing", "conditions": [("candle_pattern", "==", "bullish_engulfing")]},
        {"rule_id": "number", "conditions": [("rsi_14", "<", "low")]},
        {"rule_id": "none", "conditions": []},
        {"rule_id": "many", "conditions": [("rsi_14", "<", "1")] * 11},
        {"rule_id": "hook", "notification_channels": ["webhook"]},
        {"rule_id": "mail", "email_address": ""}, {"rule_id": "mail2", "email_address": "nobody"},
        {"rule_id": "cool", "cooldown_seconds": 10}, {"rule_id": "logic", "logic": "XOR"},
        {"rule_id": "tf", "timeframe": "2h"}, {"rule_id": "act", "action": "HOLD"},
        {"rule_id": "chan", "notification_channels": ["sms"]},
    )
    got = {r.rule_id: r.violation for r in rules.rule_violations(payloads).collect()}
    assert got == {
        "pattern": "condition value", "number": "condition value", "none": "condition count",
        "many": "condition count", "hook": "webhook url", "mail": "email address",
        "mail2": "email address", "cool": "cooldown", "logic": "logic", "tf": "timeframe",
        "act": "action", "chan": "channel",
    }
    assert rules.normalised(payloads).filter("rule_id = 'ok'").first().symbol == "BTCUSDT"
    assert sorted(r.rule_id for r in rules.valid_rules(payloads).collect()) == ["engulfing", "ok"]


def test_create_is_repeatable(spark):
    stored = table(spark, {"rule_id": "old"})
    payload = table(spark, {"symbol": "ethusdt", "cooldown_seconds": None}).drop("rule_id")
    once = rules.created(stored, payload, AT)
    twice = rules.created(once, payload, AT)
    assert once.count() == 2 and twice.count() == 2
    new = once.filter("rule_id <> 'old'").first()
    assert (new.symbol, new.cooldown_seconds, new.trigger_count) == ("ETHUSDT", 300, 0)


def test_defaults_and_rules_that_differ_by_channel(spark):
    lacking = table(spark, {"logic": None, "notification_channels": None, "cooldown_seconds": None})
    assert rules.rule_violations(rules.normalised(lacking)).count() == 0
    both = table(spark, {"notification_channels": ["email"]}, {"notification_channels": ["webhook"], "webhook_url": "https://h"})
    payloads = both.unionByName(lacking).drop("rule_id")
    made = rules.created(table(spark, {"rule_id": "old"}), payloads, AT).filter("rule_id <> 'old'").collect()
    # The one that leaves everything out equals the first, but for the cooldown's default.
    assert sorted(r.notification_channels for r in made) == [["email"], ["webhook"]]
    assert {r.logic for r in made} == {"AND"} and len({r.rule_id for r in made}) == 2


def test_clashing_ids_are_reported(spark):
    payloads = table(spark, {"rule_id": "a", "action": "SELL"}, {"rule_id": "a", "action": "BUY"}, {"rule_id": "a", "action": "BUY"},
                     {"rule_id": "b"}, {"rule_id": "b"}, {"rule_id": "c"}, {"rule_id": "c", "cooldown_seconds": 1})
    assert [tuple(r) for r in rules.id_clashes(payloads).collect()] == [("a", 2)]
    made = rules.created(table(spark, {"rule_id": "old"}), payloads.repartition(3), AT).filter("rule_id <> 'old'")
    assert sorted((r.rule_id, r.action, r.cooldown_seconds) for r in made.collect()) == [("a", "BUY", 300), ("b", "BUY", 300), ("c", "BUY", 300)]


def test_bad_patches_change_nothing(spark):
    stored = table(spark, {}, {"rule_id": "r2"}, {"rule_id": "r3"})
    patches = spark.createDataFrame(
        [("r1", "u1", "SELL", 5, None), ("r2", "u1", None, None, "XOR"), ("r3", "u1", None, 60, "OR")],
        "rule_id STRING, user_id STRING, action STRING, cooldown_seconds INT, logic STRING")
    wrong = sorted((r.rule_id, r.violation) for r in rules.patch_violations(patches).collect())
    assert wrong == [("r1", "cooldown"), ("r2", "logic")]
    got = {r.rule_id: (r.action, r.cooldown_seconds, r.logic) for r in rules.patched(stored, patches, AT).collect()}
    assert got == {"r1": ("BUY", 300, "AND"), "r2": ("BUY", 300, "AND"), "r3": ("BUY", 60, "OR")}


def test_patches_of_a_rule_apply_in_turn(spark):
    stored = table(spark, {}, {"rule_id": "r2"})
    patches = spark.createDataFrame(
        [("r1", "u1", 2, "SELL", None, False), ("r1", "u1", 1, "WATCH", 60, None), ("r1", "u1", 3, None, 5, True),
         ("r1", "u1", 4, None, None, None), ("r1", "u1", 2, None, 90, None)],
        "rule_id STRING, user_id STRING, patched_at INT, action STRING, cooldown_seconds INT, is_active BOOLEAN")
    rows = rules.patched(stored, patches, AT).collect()
    # The third is not allowed, the fourth empty.
    assert sorted((r.rule_id, r.action, r.cooldown_seconds, r.is_active) for r in rows) == [
        ("r1", "SELL", 90, False), ("r2", "BUY", 300, True)]


def test_patch_toggle_delete(spark):
    stored = table(spark, {}, {"rule_id": "r2"}, {"rule_id": "r3", "is_active": False})
    patches = spark.createDataFrame(
        [("r1", "u1", "SELL", None), ("r2", "u1", None, None), ("r3", "other", "SELL", 60)],
        "rule_id STRING, user_id STRING, action STRING, cooldown_seconds INT")
    got = {r.rule_id: r for r in rules.patched(stored, patches, AT).collect()}
    assert got["r1"].action == "SELL" and got["r1"].cooldown_seconds == 300
    assert got["r1"].updated_at != got["r2"].updated_at and got["r3"].action == "BUY"
    chosen = spark.createDataFrame([("r1", "u1"), ("r3", "u1"), ("r2", "other")], "rule_id STRING, user_id STRING")
    flags = {r.rule_id: r.is_active for r in rules.toggled(stored, chosen, AT).collect()}
    assert flags == {"r1": False, "r2": True, "r3": True}
    assert [r.rule_id for r in rules.deleted(stored, chosen).collect()] == ["r2"]


def test_pages(spark):
    stored = table(spark, *[{"rule_id": f"r{i}", "created_at": utc(2024, 1, 1 + i)} for i in range(5)],
                   {"rule_id": "x", "user_id": "u2"}, {"rule_id": "y", "symbol": "ETHUSDT"})
    page = rules.rules_page(stored, "u1", symbol="btcusdt", page=2, limit=2).collect()
    assert sorted(r.rule_id for r in page) == ["r1", "r2"] and page[0].total == 5
    with pytest.raises(ValueError):
        rules.rules_page(stored, "u1", limit=101)
    with pytest.raises(ValueError):
        rules.rule_history(stored, 201)


def bars(spark, closes, **fields):
    rows = [("BTCUSDT", "1h", utc(2024, 1, 1, h), c, c + 1, c - 1, 5.0, fields.get("rsi", 20.0), 1.0, 0.5, "HAMMER")
            for h, c in enumerate(closes)]
    made = spark.createDataFrame(
        rows, "symbol STRING, timeframe STRING, window_start TIMESTAMP, close DOUBLE, high DOUBLE, "
              "low DOUBLE, volume DOUBLE, rsi_14 DOUBLE, macd DOUBLE, macd_signal DOUBLE, candle_pattern STRING")
    return resample.add_rule_fields(made)


def test_one_alert_per_rule_with_latest_bar(spark):
    stored = table(
        spark, {}, {"rule_id": "same"}, {"rule_id": "off", "is_active": False},
        {"rule_id": "eth", "symbol": "ETHUSDT"}, {"rule_id": "tf", "timeframe": "4h"},
        {"rule_id": "cross", "conditions": [("close", "crosses_above", "11")]},
        {"rule_id": "cold", "last_triggered_at": utc(2024, 1, 31, 23, 55)},
        {"rule_id": "due", "last_triggered_at": utc(2024, 1, 31, 23, 54, 59)},
    )
    got = {r.rule_id: r for r in alerts.evaluate(bars(spark, [10.0, 12.0, 13.0]), stored, AT).collect()}
    assert set(got) == {"r1", "same", "cross", "due"}
    assert got["r1"].close_price == 13.0 and got["cross"].close_price == 12.0
    # RSI 20 gives two points and MACD 1.0 one; a volume ratio of 1 gives none.
    assert json.loads(got["r1"].message)["signal_type"] == "STRONG"
    again = alerts.evaluate(bars(spark, [10.0, 12.0, 13.0]), stored, AT)
    assert {r.alert_id for r in again.collect()} == {r.alert_id for r in got.values()}
    why = alerts.latest_matches(bars(spark, [10.0]), rules.active_rules(table(spark, {})), reasons=True).first()
    assert why.conditions_met == ["rsi_14 < 30 → ✓ (current=20.0)"]


def test_trigger_stats(spark):
    events = spark.createDataFrame([("r1", utc(2024, 1, 5)), ("r1", utc(2024, 1, 4)), ("gone", utc(2024, 1, 4))],
                                   "rule_id STRING, triggered_at TIMESTAMP")
    got = {r.rule_id: r for r in rules.with_trigger_stats(table(spark, {}, {"rule_id": "r2"}), events).collect()}
    assert got["r1"].trigger_count == 2 and got["r1"].last_triggered_at is not None
    assert got["r2"].trigger_count == 0 and got["r2"].last_triggered_at is None


EVENT = dict(alert_id="a1", rule_id="r1", user_id="u1", symbol="BTCUSDT", timeframe="1h", action="BUY",
             triggered_at=utc(2024, 1, 1), close_price=37050.0, rsi_14=28.5, macd=None, volume_ratio=0.0,
             candle_pattern=None, message="m")


def test_event_validity(spark):
    texts = ['{"alert_id":"a","rule_id":"r","user_id":null,"symbol":"S","close_price":1.5}',
             '{"alert_id":"a","rule_id":"r"}', "nope", "[1]"]
    messages = spark.createDataFrame([(t,) for t in texts], "value STRING")
    good = dispatch.valid_events(messages).collect()
    assert len(good) == 1 and good[0].close_price == 1.5 and good[0].user_id is None
    errors = sorted(r.error for r in dispatch.dead_letters(messages, AT).collect())
    assert errors == ["invalid JSON", "invalid JSON", "missing required fields: user_id, symbol"]


def test_dispatch(spark):
    events = spark.createDataFrame([tuple(EVENT.values()), tuple({**EVENT, "alert_id": "a2", "rule_id": "no"}.values())],
                                   schemas.ALERT_EVENT)
    stored = table(spark, {"notification_channels": ["email", "webhook"], "webhook_url": "https://h"})
    rows = {r.channel: r for r in dispatch.dispatch_rows(events, stored).collect()}
    assert set(rows) == {"email", "webhook"} and rows["webhook"].target == "https://h"
    assert json.loads(rows["webhook"].body)["data"]["macd"] is None
    lines = rows["email"].body.split("\n")
    assert lines[0] == "[BUY SIGNAL]" and "MACD:         N/A" in lines and "Volume Ratio: 0.00x" in lines
    assert [r.alert_id for r in dispatch.dispatch_rejects(events, stored).collect()] == ["a2"]
    message = alerts.alert_messages(events).first()
    assert message.key == "BTCUSDT" and json.loads(message.value)["alert_id"] == "a1"
    assert alerts.one_per_rule(events.withColumn("window_start", F.col("triggered_at"))).count() == 2


def _random_rules(spark, count, seed, operators, values):
    walk = random.Random(seed)
    made = []
    for i in range(count):
        conditions = [
            (walk.choice(("close", "rsi_14", "candle_pattern", "spread")), walk.choice(operators), walk.choice(values))
            for _ in range(walk.randint(0, 3))]
        made.append({"rule_id": f"r{i}", "conditions": conditions, "logic": walk.choice(("AND", "OR", "and", "XOR"))})
    return rules.active_rules(table(spark, *made))


def _random_bars(spark, count, seed):
    walk = random.Random(seed)
    number = lambda: walk.choice((None, float("nan"), 0.0, 1.0, 2.0, 2.5, 3.0, 10.0))
    rows = [("BTCUSDT", "1h", utc(2024, 1, 1) + timedelta(hours=i), number(), number(), number(), number(),
             walk.choice((None, "HAMMER", "DOJI", "BULLISH")), 0.5, 1.5) for i in range(count)]
    return spark.createDataFrame(
        rows, "symbol STRING, timeframe STRING, window_start TIMESTAMP, close DOUBLE, prev_close DOUBLE, rsi_14 DOUBLE, "
        "prev_rsi_14 DOUBLE, candle_pattern STRING, macd DOUBLE, volume_ratio DOUBLE")


@pytest.mark.parametrize("block", [1, 3, 64])
def test_index_finds_what_testing_every_rule_finds(spark, monkeypatch, block):
    monkeypatch.setattr(alerts.rule_index, "__defaults__", (block,))
    operators = (">", "<", ">=", "<=", "==", "!=", "crosses_above", "crosses_below", "between")
    some = _random_rules(spark, 150, block, operators, ("0", "1", "2", "2.5", "3", "nan", "hammer", "DOJI", "low"))
    bars = _random_bars(spark, 60, block)
    got = alerts.matches(bars, some).groupBy(alerts.PREDICATE, "window_start").count().collect()
    every = alerts._bar_values(bars).join(alerts.predicates(some), ["symbol", "timeframe"])
    want = every.filter(rule_met(F.col("conditions"), F.col("logic"), F.col("_now"), F.col("_before")))
    assert {r["count"] for r in got} == {1}
    assert {(r[0], r[1]) for r in got} == {(r[0], r[1]) for r in want.select(alerts.PREDICATE, "window_start").collect()}


def test_opened_blocks_do_not_grow_with_the_thresholds(spark):
    """A crossing passes as many thresholds as lie between two values; others' blocks stay shut."""
    def opened(count):
        made = [{"rule_id": f"r{i}", "conditions": [("close", "crosses_above", str(100 * i / count))]} for i in range(count)]
        index = alerts.rule_index(rules.active_rules(table(spark, *made)))
        assert index.count() == -(-count // alerts.INDEX_BLOCK)
        now, was = F.lit(50.001), F.lit(49.999)
        return index.filter(alerts._may_meet(now, F.col("current")) & alerts._may_meet(was, F.col("previous"))).count()

    assert opened(64) == 1 and opened(6400) <= 2
