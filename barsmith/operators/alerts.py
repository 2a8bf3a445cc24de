"""Matching bars with rules, and the alert rows that come of it.

Many rules share one predicate: the same symbol, timeframe, logic and conditions. Predicates are
filed in an index by one of their conditions if all must hold, by each of them if any may. The
entries of a symbol, timeframe, field and operator are sorted by threshold and cut into blocks
with their least and greatest one. A bar compares its value with the bounds of each block, opens
those that may hold entries it meets, and only what it meets is tested as a whole: work grows
with what is met and hardly with the number of thresholds. Matches are folded to the latest bar per predicate and only then joined to the
rules. The result is that of every rule tested on every bar, as cooldown and one-alert-per-rule
depend on the rule alone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import signal_message
from ..functions.conditions import (
    ANY, EQUAL, FIELDS, GREATER, LESS, condition_met, condition_reason, field_values, prepared_conditions,
)
from ..schemas import ALERT_COLUMNS
from ..vocabulary import RULE_PATTERNS
from .resample import GOLD_KEYS
from .rules import active_rules

PREDICATE = "_predicate"
#: Entries in a block of the index.
INDEX_BLOCK = 64
_BAR_COLUMNS = (
    "window_start", "close", "rsi_14", "macd", "volume_ratio", "candle_pattern",
)


def realtime(bars: DataFrame, started_at: datetime | None) -> DataFrame:
    """Drop bars from before the pipeline started: backfilled data raises no alerts."""
    if started_at is None:
        return bars
    return bars.filter(F.col("window_start") >= F.lit(started_at).cast("timestamp"))


def with_predicate(rules: DataFrame) -> DataFrame:
    """Add the id that equal rules share. It covers symbol and timeframe too, so grouping by
    it alone forces a shuffle after the join and leaves skewed joins free to be split."""
    text = F.to_json(F.struct(*GOLD_KEYS, F.upper("logic").alias("logic"), "conditions"))
    return rules.withColumn(PREDICATE, F.sha2(text, 256))


def predicates(rules: DataFrame) -> DataFrame:
    distinct = with_predicate(rules).groupBy(PREDICATE).agg(
        *[F.any_value(c).alias(c) for c in (*GOLD_KEYS, "logic", "conditions")]
    )
    return distinct.withColumns({
        "logic": F.upper("logic"),
        "conditions": prepared_conditions(F.col("conditions")),
    })


def _bar_values(bars: DataFrame) -> DataFrame:
    """Bars with previous values (see ``add_previous``) reduced to what evaluation reads."""
    return bars.select(
        *GOLD_KEYS, *_BAR_COLUMNS,
        field_values(bars.columns).alias("_now"),
        field_values(bars.columns, "prev_").alias("_before"),
    )


_VALUES = ("_now", "_before")


def rule_index(rules: DataFrame, block: int = INDEX_BLOCK) -> DataFrame:
    """(symbol, timeframe, slot, current, previous, least, greatest, entries): predicates by the
    conditions they are filed under.

    Where all conditions must hold, a crossing is preferred, then an equality. Predicates that no
    bar can meet are left out.
    """
    conditions = F.col("conditions")

    def possible(c: Column) -> Column:
        return c["slot"].isNotNull() & (c["current"] > 0)

    def choice(c: Column, i: Column) -> Column:
        rank = F.when(c["previous"] != ANY, 0).when(c["current"] == EQUAL, 1).otherwise(2)
        return F.struct(rank.alias("rank"), i.alias("i"))

    places = F.sequence(F.lit(0), F.size(conditions) - 1)
    filed = F.when(
        (F.col("logic") == "AND") & F.forall(conditions, possible),
        F.array(F.array_min(F.transform(conditions, choice))["i"]),
    ).when(F.col("logic") == "OR", F.filter(places, lambda i: possible(F.get(conditions, i))))
    entries = (
        predicates(rules).filter(F.size(conditions) > 0)
        .select(PREDICATE, *GOLD_KEYS, "logic", "conditions", F.explode(filed).alias("_entry"))
        .withColumn("_filed", F.get("conditions", F.col("_entry")))
    )
    kind = [*GOLD_KEYS, "slot", "current", "previous"]
    entries = entries.select(
        *GOLD_KEYS, *(F.col(f"_filed.{c}").alias(c) for c in ("slot", "current", "previous", "number")),
        PREDICATE, "logic", "conditions", "_entry",
    )
    place = F.row_number().over(Window.partitionBy(*kind).orderBy("number", PREDICATE, "_entry"))
    blocks = entries.withColumn("_block", F.floor((place - 1) / block))
    row = F.struct("number", PREDICATE, "_entry", "logic", "conditions")
    return blocks.groupBy(*kind, "_block").agg(
        F.min("number").alias("least"), F.max("number").alias("greatest"), F.collect_list(row).alias("entries")
    ).drop("_block")


def _may_meet(value: Column, outcomes: Column) -> Column:
    """Whether comparing the value with some number of a block can have an outcome of the set."""
    least, greatest = F.col("least"), F.col("greatest")

    def has(outcome: int) -> Column:
        return outcomes.bitwiseAND(F.lit(outcome)) > 0

    return (
        (has(GREATER) & (value > least)) | (has(LESS) & (value < greatest))
        | (has(EQUAL) & (value >= least) & (value <= greatest))
    )


def _meets(value: Column, number: Column, outcomes: Column) -> Column:
    return outcomes.bitwiseAND(F.when(value < number, LESS).when(value == number, EQUAL).otherwise(GREATER)) > 0


def matches(bars: DataFrame, rules: DataFrame) -> DataFrame:
    """Bars that meet a predicate, one row per bar and distinct predicate.

    No hint: Spark broadcasts the index below its size threshold and otherwise shuffles,
    splitting a hot symbol's bars.
    """
    values = [F.col(c) for c in _VALUES]
    value, was = (F.get(c, F.col("slot") - 1) for c in _VALUES)
    current, previous = F.col("current"), F.col("previous")
    any_before = previous == ANY
    opened = _bar_values(bars).join(rule_index(rules), list(GOLD_KEYS)).filter(
        value.isNotNull() & _may_meet(value, current)
        & (any_before | (was.isNotNull() & _may_meet(was, previous)))
    )
    met = opened.select(
        *GOLD_KEYS, *_BAR_COLUMNS, *_VALUES, "slot", "current", "previous", F.inline("entries")
    ).filter(
        _meets(value, F.col("number"), current) & (any_before | _meets(was, F.col("number"), previous))
    )
    conditions = F.col("conditions")

    def holds(c: Column) -> Column:
        return condition_met(c, *values)

    # Of several conditions that hold, the first one gives the row.
    whole = (F.size(conditions) == 1) | F.when(
        F.col("logic") == "AND", F.forall(conditions, holds)
    ).otherwise((F.col("_entry") == 0) | ~F.exists(F.slice(conditions, F.lit(1), F.col("_entry")), holds))
    return met.filter(whole).select(PREDICATE, *GOLD_KEYS, *_BAR_COLUMNS, *_VALUES)


def condition_counts(bars: DataFrame, rules: DataFrame) -> DataFrame:
    """For every distinct condition, how many bars were tested and how many met it.

    Counted under one id, as predicates are, so that a hot symbol's join can be split.
    """
    names = (*GOLD_KEYS, "condition.field", "condition.operator", "condition.value")
    conditions = (
        predicates(rules)
        .select(*GOLD_KEYS, F.explode("conditions").alias("condition"))
        .distinct()
        .withColumn("_condition", F.sha2(F.to_json(F.struct(*GOLD_KEYS, "condition")), 256))
    )
    values = [F.col(c) for c in _VALUES]
    tested = _bar_values(bars).join(conditions, list(GOLD_KEYS)).select(
        "_condition", condition_met(F.col("condition"), *values).cast("bigint").alias("met")
    )
    counts = tested.groupBy("_condition").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("met").alias("bars_met")
    )
    return conditions.join(counts, "_condition").select(*names, "bars", "bars_met")


def match_counts(bars: DataFrame, rules: DataFrame) -> DataFrame:
    """Per rule, the number of bars that meet it and the first and last of them."""
    counts = matches(bars, rules).groupBy(PREDICATE).agg(
        F.count(F.lit(1)).alias("bars_met"),
        F.min("window_start").alias("first_window"),
        F.max("window_start").alias("last_window"),
    )
    return with_predicate(rules).join(counts, PREDICATE).select(
        "rule_id", *GOLD_KEYS, "bars_met", "first_window", "last_window"
    )


def latest_matches(bars: DataFrame, rules: DataFrame, reasons: bool = False) -> DataFrame:
    """Each rule with the last bar that meets it, and on request its conditions' outcomes.

    Without reasons every aggregate buffer is a number, the pattern included, so matches fold
    in a hash aggregate before the shuffle; the value arrays that reasons need force a sort.
    """
    found = matches(bars, rules)
    at = F.col("window_start")
    numbers = ("close", "rsi_14", "macd", "volume_ratio")
    if not reasons:
        code = F.element_at("_now", len(FIELDS)).cast("int")
        last = found.groupBy(PREDICATE).agg(
            F.max(at).alias("window_start"),
            *[F.max_by(c, at).alias(c) for c in numbers],
            F.max_by(code, at).alias("_pattern"),
        )
        names = F.array(*[F.lit(p) for p in RULE_PATTERNS])
        last = last.withColumn("candle_pattern", F.get(names, F.col("_pattern") - 1)).drop("_pattern")
        return with_predicate(rules).join(last, PREDICATE).drop(PREDICATE)
    row = F.struct(*_BAR_COLUMNS, "_now", "_before")
    last = found.groupBy(PREDICATE).agg(F.max_by(row, at).alias("_bar"))
    values = [F.col(c) for c in _VALUES]
    outcome = F.transform(
        prepared_conditions(F.col("conditions")),
        lambda c: condition_reason(c, *values, F.col("candle_pattern")),
    )
    joined = with_predicate(rules).join(last, PREDICATE).select(*rules.columns, "_bar.*")
    return joined.withColumn("conditions_met", outcome).drop("_now", "_before")


def after_cooldown(rules: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Rules (or their matches) never triggered, or triggered strictly longer ago than their cooldown."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    elapsed = F.unix_seconds(now) - F.unix_seconds("last_triggered_at")
    return rules.filter(
        F.col("last_triggered_at").isNull() | (elapsed > F.col("cooldown_seconds"))
    )


def alert_rows(matched: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Alert events with the signal message.

    The id covers the trigger time, as a long bar can fire again after each cooldown. A replay
    with the same ``as_of`` gives the same ids.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    start, fired = (
        F.date_format(t, "yyyy-MM-dd HH:mm:ss") for t in (F.col("window_start"), now.cast("timestamp")))
    return matched.select(
        F.sha2(F.concat_ws("|", "rule_id", "symbol", "timeframe", start, fired), 256).alias("alert_id"),
        "rule_id", "user_id", "symbol", "timeframe", "action",
        now.cast("timestamp").alias("triggered_at"),
        F.col("close").alias("close_price"),
        "rsi_14", "macd", "volume_ratio", "candle_pattern", "window_start",
        signal_message(*[
            F.col(c) for c in (
                "symbol", "action", "close", "rsi_14", "macd", "volume_ratio",
                "candle_pattern", "rule_id",
            )
        ]).alias("message"),
        *(["conditions_met"] if "conditions_met" in matched.columns else []),
    )


def one_per_rule(alerts: DataFrame) -> DataFrame:
    """The alert with the latest bar of each rule; equal bars go to the first symbol."""
    newest = Window.partitionBy("rule_id").orderBy(
        F.col("window_start").desc(), "symbol", "timeframe", "alert_id"
    )
    return (
        alerts.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def evaluate(
    bars: DataFrame, rules: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """Active rules against bars that carry previous values: at most one alert per rule.

    Rules that are cooling down are left out first, which spares their predicates' tests.
    """
    return alert_rows(latest_matches(bars, after_cooldown(active_rules(rules), as_of)), as_of)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as key and JSON value for a message topic."""
    return alerts.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*ALERT_COLUMNS)).alias("value")
    )
