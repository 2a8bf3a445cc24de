"""Rule conditions as column expressions.

A condition is prepared once per rule and tested once per bar. Preparing resolves the field to
a position, the value to a number, and the operator to the set of comparison outcomes that
satisfy it. Testing is then an array lookup, one comparison and a bit test, with no text
handling per bar: a pattern compares as its number in the list of patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import NUMERIC_FIELDS, OPERATORS, PATTERN_FIELD, RULE_PATTERNS

LESS, EQUAL, GREATER = 1, 2, 4
ANY = LESS | EQUAL | GREATER
# Outcomes of comparing the current value that satisfy each operator.
CURRENT = {
    ">": GREATER, "<": LESS, ">=": GREATER | EQUAL, "<=": LESS | EQUAL, "==": EQUAL,
    "!=": LESS | GREATER, "crosses_above": GREATER, "crosses_below": LESS,
}
# Outcomes required of the previous value; the other operators do not look at it.
PREVIOUS = {"crosses_above": LESS | EQUAL, "crosses_below": GREATER | EQUAL}
FIELDS = (*NUMERIC_FIELDS, PATTERN_FIELD)


def _pattern_number(pattern: Column) -> Column:
    names = F.array(*[F.lit(p) for p in RULE_PATTERNS])
    return F.nullif(F.array_position(names, F.upper(pattern)), F.lit(0)).cast("double")


def field_values(columns: list[str], prefix: str = "") -> Column:
    """The rule fields of a bar as an array, NULL where the bar lacks the column."""
    missing = F.lit(None).cast("double")
    numbers = [
        F.col(prefix + f).cast("double") if prefix + f in columns else missing
        for f in NUMERIC_FIELDS
    ]
    has_pattern = not prefix and PATTERN_FIELD in columns
    pattern = _pattern_number(F.col(PATTERN_FIELD)) if has_pattern else missing
    return F.array(*numbers, pattern)


def _by_operator(operator: Column, outcomes: dict[str, int], otherwise: int) -> Column:
    mask = F.lit(otherwise)
    for name, outcome in outcomes.items():
        mask = F.when(operator == name, outcome).otherwise(mask)
    return mask


def prepared_conditions(conditions: Column) -> Column:
    """Add slot, number and outcome sets to each condition.

    Text equality of a number field with something that is no number never holds, and its
    inequality always does. A pattern field knows equality and inequality only.
    """
    names = F.array(*[F.lit(f) for f in FIELDS])

    def prepare(c: Column) -> Column:
        is_pattern = c["field"] == PATTERN_FIELD
        operator = c["operator"]
        number = F.when(is_pattern, _pattern_number(c["value"])).otherwise(
            c["value"].try_cast("double")
        )
        usable = number.isNotNull() & (~is_pattern | operator.isin("==", "!="))
        return F.struct(
            c["field"].alias("field"),
            operator.alias("operator"),
            c["value"].alias("value"),
            F.nullif(F.array_position(names, c["field"]), F.lit(0)).cast("int").alias("slot"),
            F.coalesce(number, F.lit(0.0)).alias("number"),
            F.when(usable, _by_operator(operator, CURRENT, 0))
            .when(operator == "!=", ANY)
            .otherwise(0)
            .alias("current"),
            _by_operator(operator, PREVIOUS, ANY).alias("previous"),
        )

    return F.transform(conditions, prepare)


def _value(values: Column, condition: Column) -> Column:
    return F.get(values, condition["slot"] - 1)


def _outcome(value: Column, number: Column) -> Column:
    return F.when(value < number, LESS).when(value == number, EQUAL).when(value > number, GREATER)


def condition_met(condition: Column, now: Column, before: Column) -> Column:
    """Whether one condition holds; unknown fields, operators and NULL values do not."""
    number, required = condition["number"], condition["previous"]
    current = condition["current"].bitwiseAND(_outcome(_value(now, condition), number)) > 0
    previous = required.bitwiseAND(_outcome(_value(before, condition), number)) > 0
    return F.coalesce(current & ((required == ANY) | previous), F.lit(False))


def condition_reason(
    condition: Column, now: Column, before: Column, pattern: Column
) -> Column:
    """The condition, its outcome and the current value as text, or why it has no outcome."""
    field, operator = condition["field"], condition["operator"]
    number = _value(now, condition).cast("string")
    shown = F.when(field == PATTERN_FIELD, pattern).otherwise(number)
    mark = F.when(condition_met(condition, now, before), "✓").otherwise("✗")
    return (
        F.when(shown.isNull(), F.concat(field, F.lit(" is None")))
        .when(
            operator.startswith("crosses_") & _value(before, condition).isNull(),
            F.concat(F.lit("No previous data for "), field),
        )
        .when(~operator.isin(*OPERATORS), F.concat(F.lit("Unknown operator: "), operator))
        .otherwise(
            F.format_string(
                "%s %s %s → %s (current=%s)", field, operator, condition["value"], mark, shown
            )
        )
    )


def rule_met(conditions: Column, logic: Column, now: Column, before: Column) -> Column:
    """AND needs every condition, OR any; no conditions or another logic is never met."""

    def met(c):
        return condition_met(c, now, before)

    outcome = F.when(logic == "AND", F.forall(conditions, met)).when(
        logic == "OR", F.exists(conditions, met)
    )
    return F.coalesce((F.size(conditions) > 0) & outcome, F.lit(False))
