"""Alert rules as a table: validation, changes, state and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..vocabulary import (
    ACTIONS, CHANNELS, DEFAULT_COOLDOWN, INTERVAL_SECONDS, LOGICS, MAX_CONDITIONS, MAX_COOLDOWN,
    MAX_PAGE, MAX_RULE_HISTORY, MIN_CONDITIONS, MIN_COOLDOWN, NUMERIC_FIELDS, OPERATORS,
    PATTERN_FIELD, RULE_HISTORY, RULE_PATTERNS,
)

RULE_KEY = ("rule_id", "user_id")
PATCHABLE = (
    "conditions", "logic", "action", "notification_channels", "email_address", "webhook_url",
    "cooldown_seconds", "is_active",
)


def active_rules(rules: DataFrame) -> DataFrame:
    """What evaluation needs of the active rules; conditions stay nested."""
    return rules.filter("is_active").select(
        "rule_id", "user_id", "symbol", "timeframe", "action", "cooldown_seconds",
        "last_triggered_at", "conditions", "logic",
    )


def normalised(payloads: DataFrame) -> DataFrame:
    """Payloads with their symbol in upper case and the defaults of members left out."""
    defaults = {
        "logic": F.lit(LOGICS[0]), "notification_channels": F.array(F.lit(CHANNELS[0])),
        "cooldown_seconds": F.lit(DEFAULT_COOLDOWN), "is_active": F.lit(True),
    }
    given = set(payloads.columns)
    filled = {c: F.coalesce(c, d) if c in given else d for c, d in defaults.items()}
    return payloads.withColumns({"symbol": F.upper("symbol"), **filled})


def _bad_condition(c: Column) -> Column:
    is_pattern = c["field"] == PATTERN_FIELD
    known_field = c["field"].isin(PATTERN_FIELD, *NUMERIC_FIELDS)
    pattern_ok = F.upper(c["value"]).isin(*RULE_PATTERNS)
    number_ok = c["value"].try_cast("double").isNotNull()
    fine = known_field & c["operator"].isin(*OPERATORS) & F.when(is_pattern, pattern_ok).otherwise(
        number_ok
    )
    return ~F.coalesce(fine, F.lit(False))


def _checks() -> dict[str, Column]:
    """Name of each violation of a whole rule and the test that raises it."""

    def outside(name: str, values) -> Column:
        return ~F.coalesce(F.col(name).isin(*values), F.lit(False))

    channels, count = F.col("notification_channels"), F.size("conditions")
    email, url = F.col("email_address"), F.col("webhook_url")
    return {
        "condition count": ~F.coalesce(count.between(MIN_CONDITIONS, MAX_CONDITIONS), F.lit(False)),
        "condition value": F.exists("conditions", _bad_condition),
        "logic": outside("logic", LOGICS),
        "action": outside("action", ACTIONS),
        "timeframe": outside("timeframe", INTERVAL_SECONDS),
        "cooldown": ~F.col("cooldown_seconds").between(MIN_COOLDOWN, MAX_COOLDOWN),
        "channel": F.exists(channels, lambda c: ~F.coalesce(c.isin(*CHANNELS), F.lit(False))),
        "email address": F.array_contains(channels, "email")
        & ~F.coalesce(email.contains("@"), F.lit(False)),
        "webhook url": F.array_contains(channels, "webhook")
        & ~F.coalesce(F.length(url) > 0, F.lit(False)),
    }


#: The member that each check of a patch is about; targets are checked with the whole rule only.
_PATCH_CHECKS = {
    "condition count": "conditions", "condition value": "conditions", "logic": "logic", "action": "action",
    "cooldown": "cooldown_seconds", "channel": "notification_channels",
}


def _failed(checks: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks.items()]))


def rule_violations(payloads: DataFrame) -> DataFrame:
    """A row per rule and failed check; a rule without rows is valid. Expects ``normalised``."""
    return payloads.select("rule_id", F.explode(_failed(_checks())).alias("violation"))


def _patch_failures(columns) -> Column:
    checks = _checks()
    return _failed({
        name: F.col(member).isNotNull() & checks[name]
        for name, member in _PATCH_CHECKS.items() if member in columns
    })


def patch_violations(patches: DataFrame) -> DataFrame:
    """A row per patch and failed check of the members that it gives."""
    return patches.select(*RULE_KEY, F.explode(_patch_failures(patches.columns)).alias("violation"))


def valid_rules(payloads: DataFrame) -> DataFrame:
    checks = list(_checks().values())
    bad = checks[0]
    for check in checks[1:]:
        bad = bad | F.coalesce(check, F.lit(False))
    return payloads.filter(~bad)


def _identified(payloads: DataFrame) -> DataFrame:
    """Complete payloads with their id and, as ``_content``, all that they say."""
    complete = normalised(payloads)
    content = F.to_json(F.struct(*sorted(c for c in complete.columns if c != "rule_id")))
    identity = F.sha2(content, 256)
    rule_id = F.coalesce("rule_id", identity) if "rule_id" in payloads.columns else identity
    return complete.withColumns({"rule_id": rule_id, "_content": content})


def created(rules: DataFrame, payloads: DataFrame, at: datetime) -> DataFrame:
    """Add valid new rules with the server-side defaults.

    The id is a hash of the whole payload, so replaying a creation gives the same id and rules
    that differ in anything have their own; a rule that is already in the table is not added
    twice. Of payloads that give one id for different rules the first by content is added, see
    ``id_clashes``.
    """
    stamp = F.lit(at).cast("timestamp")
    sound = valid_rules(_identified(payloads))
    columns = [c for c in sound.columns if c not in ("rule_id", "_content")]
    first = sound.groupBy("rule_id").agg(F.min_by(F.struct(*columns), "_content").alias("_rule"))
    new = first.select("rule_id", "_rule.*").withColumns({
        "created_at": stamp,
        "updated_at": stamp,
        "last_triggered_at": F.lit(None).cast("timestamp"),
        "trigger_count": F.lit(0),
    })
    unseen = new.join(rules.select("rule_id"), "rule_id", "left_anti")
    return rules.unionByName(unseen.select(*rules.columns))


def id_clashes(payloads: DataFrame) -> DataFrame:
    """(rule_id, variants): ids that valid payloads give for rules that differ, of which one is added."""
    variants = valid_rules(_identified(payloads)).select("rule_id", "_content").distinct()
    counted = variants.groupBy("rule_id").agg(F.count(F.lit(1)).alias("variants"))
    return counted.filter(F.col("variants") > 1)


def patched(
    rules: DataFrame, patches: DataFrame, at: datetime, order: Sequence[str] = ("patched_at",)
) -> DataFrame:
    """Rules with the fields that their patches give, one row per rule however many patches it has.

    Patches apply one after the other by their ``order`` columns, as far as they have them, and
    then by content: each field takes its last value. Empty patches change nothing, nor do those
    with a violation: see ``patch_violations``.
    """
    fields = [f for f in PATCHABLE if f in patches.columns]
    sound = patches.filter(F.size(_patch_failures(patches.columns)) == 0).dropna(how="all", subset=fields)
    turn = F.struct(*(c for c in order if c in patches.columns), F.to_json(F.struct(*fields)).alias("_content"))
    given = sound.withColumn("_turn", turn).groupBy(*RULE_KEY).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col("_turn"))).alias(f"_{f}") for f in fields],
        F.lit(True).alias("_patched"),
    )
    changed = rules.join(given, list(RULE_KEY), "left").withColumns({
        **{f: F.coalesce(f"_{f}", f) for f in fields},
        "updated_at": F.when(F.col("_patched"), F.lit(at).cast("timestamp")).otherwise(
            F.col("updated_at")
        ),
    })
    return changed.select(*rules.columns)


def toggled(rules: DataFrame, chosen: DataFrame, at: datetime) -> DataFrame:
    """Flip the active flag of the chosen rules."""
    marks = chosen.select(*RULE_KEY).distinct().withColumn("_chosen", F.lit(True))
    hit = F.col("_chosen").isNotNull()
    changed = rules.join(marks, list(RULE_KEY), "left").withColumns({
        "is_active": F.col("is_active") != hit,
        "updated_at": F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("updated_at")),
    })
    return changed.select(*rules.columns)


def deleted(rules: DataFrame, chosen: DataFrame) -> DataFrame:
    return rules.join(chosen.select(*RULE_KEY), list(RULE_KEY), "left_anti")


def rules_page(
    rules: DataFrame, user_id: str, symbol: str | None = None, timeframe: str | None = None,
    is_active: bool | None = None, page: int = 1, limit: int = 20,
) -> DataFrame:
    """One page of a user's rules, newest first, with the total of the filter.

    The total is an ordinary aggregate joined to the page, so a user with very many rules is
    counted by all tasks.
    """
    if page < 1 or not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"page must be 1 or more and limit 1 to {MAX_PAGE}")
    found = rules.filter(F.col("user_id") == user_id)
    if symbol:
        found = found.filter(F.col("symbol") == symbol.upper())
    if timeframe:
        found = found.filter(F.col("timeframe") == timeframe)
    if is_active is not None:
        found = found.filter(F.col("is_active") == is_active)
    total = found.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    newest = found.orderBy(F.col("created_at").desc(), F.col("rule_id").desc())
    return newest.offset((page - 1) * limit).limit(limit).join(total, "user_id")


def rule_by_id(rules: DataFrame, rule_id: str, user_id: str) -> DataFrame:
    return rules.filter((F.col("rule_id") == rule_id) & (F.col("user_id") == user_id))


def rule_history(events: DataFrame, limit: int = RULE_HISTORY) -> DataFrame:
    """The last events of every rule of every user. Filters on rule and user push down."""
    if not 1 <= limit <= MAX_RULE_HISTORY:
        raise ValueError(f"limit must be 1 to {MAX_RULE_HISTORY}")
    newest = Window.partitionBy(*RULE_KEY).orderBy(
        F.col("triggered_at").desc(), F.col("alert_id").desc()
    )
    return (
        events.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= limit)
        .drop("_rank")
    )


def trigger_state(events: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(rule_id, last_triggered_at, trigger_count) of the events, on top of an earlier state."""
    state = events.groupBy("rule_id").agg(
        F.max("triggered_at").alias("last_triggered_at"), F.count(F.lit(1)).alias("trigger_count")
    )
    if before is None:
        return state
    return before.unionByName(state).groupBy("rule_id").agg(
        F.max("last_triggered_at").alias("last_triggered_at"), F.sum("trigger_count").alias("trigger_count")
    )


def with_trigger_stats(rules: DataFrame, events: DataFrame) -> DataFrame:
    """Rules with their last trigger and trigger count advanced by the events."""
    return with_trigger_state(rules, trigger_state(events))


def with_trigger_state(rules: DataFrame, state: DataFrame) -> DataFrame:
    """Rules with their last trigger and trigger count advanced by a state."""
    stats = state.select(
        "rule_id", F.col("last_triggered_at").alias("_last"), F.col("trigger_count").alias("_count"))
    folded = rules.join(stats, "rule_id", "left").withColumns({
        "last_triggered_at": F.greatest("last_triggered_at", "_last"),
        "trigger_count": (F.col("trigger_count") + F.coalesce("_count", F.lit(0))).cast("int"),
    })
    return folded.select(*rules.columns)
