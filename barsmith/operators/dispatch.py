"""Alert events on their way out: validity, dead letters, lookup, fan-out and bodies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ALERT_EVENT

REQUIRED = ("alert_id", "rule_id", "user_id", "symbol")


def checked_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with an ``error`` column, NULL for an event that can be dispatched.

    A required field must be present; its value may be NULL. The error comes out of a
    generator so that a filter on it is not pushed into, and repeated with, the reading of keys.
    """
    keys = F.json_object_keys(F.col(value).cast("string"))
    missing = F.array_compact(F.array(*[
        F.when(~F.array_contains("_keys", name), name) for name in REQUIRED
    ]))
    error = F.when(F.col("_keys").isNull(), "invalid JSON").when(
        F.size(missing) > 0,
        F.concat(F.lit("missing required fields: "), F.array_join(missing, ", ")),
    )
    parsed = messages.withColumn("_keys", keys)
    return parsed.withColumn("error", F.explode(F.array(error))).drop("_keys")


def valid_events(messages: DataFrame, value: str = "value") -> DataFrame:
    good = checked_events(messages, value).filter(F.col("error").isNull())
    return good.select(F.from_json(F.col(value).cast("string"), ALERT_EVENT).alias("e")).select("e.*")


def dead_letters(messages: DataFrame, at: datetime | None = None, value: str = "value") -> DataFrame:
    """Rejected messages with the time and the reason."""
    now = F.current_timestamp() if at is None else F.lit(at)
    bad = checked_events(messages, value).filter(F.col("error").isNotNull())
    return bad.select(
        now.cast("timestamp").alias("timestamp"), "error",
        F.col(value).cast("string").alias("event"),
    )


def _shown(value: Column, pattern: str) -> Column:
    return F.when(value.isNotNull(), F.format_string(pattern, value)).otherwise("N/A")


def alert_text(footer: str = "Automated Alert") -> Column:
    """The alert as plain text; unknown values read N/A."""
    action = F.coalesce("action", F.lit("SIGNAL"))
    at = F.date_format("triggered_at", "yyyy-MM-dd'T'HH:mm:ss")
    lines = [
        F.format_string("[%s SIGNAL]", action),
        F.lit(""),
        F.format_string(
            "Symbol:       %s (%s)",
            F.coalesce("symbol", F.lit("UNKNOWN")), F.coalesce("timeframe", F.lit("")),
        ),
        F.concat(F.lit("Price:        "), _shown(F.col("close_price"), "%.4f USDT")),
        F.concat(F.lit("RSI(14):      "), _shown(F.col("rsi_14"), "%.2f")),
        F.concat(F.lit("MACD:         "), _shown(F.col("macd"), "%.4f")),
        F.concat(F.lit("Volume Ratio: "), _shown(F.col("volume_ratio"), "%.2fx")),
        F.concat(F.lit("Pattern:      "), F.coalesce("candle_pattern", F.lit("N/A"))),
        F.concat(F.lit("Triggered At: "), F.coalesce(at, F.lit("N/A"))),
        F.format_string("Rule ID:      %s...", F.substring(F.coalesce("rule_id", F.lit("N/A")), 1, 12)),
        F.lit(""),
        F.lit("---"),
        F.lit(footer),
    ]
    return F.concat_ws("\n", *lines)


def webhook_payload() -> Column:
    """The body posted to a webhook."""
    return F.to_json(
        F.struct(
            F.lit("alert_triggered").alias("event_type"),
            "rule_id", "user_id", "symbol", "timeframe", "action",
            F.coalesce(F.col("triggered_at").cast("string"), F.lit("")).alias("triggered_at"),
            F.struct("close_price", "rsi_14", "macd", "volume_ratio", "candle_pattern").alias("data"),
        ),
        {"ignoreNullFields": "false"},
    )


def dispatch_rows(events: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per event and channel of its rule, with the target and the body to send."""
    routes = rules.select("rule_id", "notification_channels", "email_address", "webhook_url")
    sent = events.join(routes, "rule_id").withColumn("channel", F.explode("notification_channels"))
    is_email = F.col("channel") == "email"
    return sent.select(
        *events.columns, "channel",
        F.when(is_email, F.col("email_address")).otherwise(F.col("webhook_url")).alias("target"),
        F.when(is_email, alert_text()).otherwise(webhook_payload()).alias("body"),
    )


def dispatch_rejects(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Events whose rule is gone; they are not retried."""
    return events.join(rules.select("rule_id"), "rule_id", "left_anti")
