"""Tool-call linking for chat data.

Calls and results are hash-joined by (conversation, call id). A call may name the call it
follows; these links are put in topological order by doubling jumps, so a chain of n calls takes
log2(n) rounds and no conversation is ever gathered in one task. Arguments are validated
against the tool's schema, and each exchange is written as canonical JSON: keys sorted, no
white space, numbers in shortest form.

``link`` takes three tables:

* calls: conv_id, call_id, after (id of the call before it, or null), turn, name, arguments (JSON text)
* results: conv_id, call_id, turn, content
* schemas: name, schema (JSON text; type or a list of types, properties, required,
  additionalProperties, items, enum, const, anyOf, oneOf, allOf, not, pattern, minimum, maximum,
  minLength, maxLength and true or false as a schema are understood)

Statuses: ``linked``, ``unanswered`` (no result), ``orphan`` (a result without its call), and in
plain chats ``context`` (a turn that neither asks nor answers, such as a system's). Errors
name what a schema objects to, ``unknown_tool``, ``bad_json``, ``missing_parent`` and ``cycle``; a schema
that uses other keywords, unknown types or a pattern that doesn't compile adds ``unsupported`` with the
keyword, so that no call passes as valid by a rule that was never applied.

Defined cases: of calls (or results) that repeat an id within a conversation the first by turn,
then by text, is used and ``n_copies`` counts them; calls without a conversation or an id can't
be linked: they are unanswered or orphans; null arguments are bad JSON, a null content is
kept as null; a call whose parent doesn't exist starts a chain; calls in a cycle, or after one,
have a null depth and come last; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped, stash

#: Turns that are ranked together; a long conversation is ranked in parts of so many turns.
TURNS = 1024

TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "number": (int, float), "integer": int,
    "null": type(None),
}


#: Keywords that ``violations`` applies, and those that only describe.
APPLIED = {
    "type", "enum", "const", "anyOf", "oneOf", "allOf", "not", "properties", "required", "additionalProperties",
    "items", "minLength", "maxLength", "pattern", "minimum", "maximum",
}
DESCRIPTIVE = {"title", "description", "default", "examples", "$schema", "$id", "$comment", "deprecated"}


def is_type(value, kind) -> bool:
    if isinstance(value, bool) and kind in ("number", "integer"):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, TYPES[kind])


def same(a, b) -> bool:
    """Equality of JSON values: true is not 1, 1.0 is 1."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


def combined(value, schema: dict, at: str) -> list[str]:
    """What anyOf, oneOf, allOf and not object to."""
    def fitting(name):
        return sum(not violations(value, one, at) for one in schema[name])

    out = []
    if "anyOf" in schema and not fitting("anyOf"):
        out.append(f"{at}: none of anyOf")
    if "oneOf" in schema and fitting("oneOf") != 1:
        out.append(f"{at}: not one of oneOf")
    for one in schema.get("allOf", ()):
        out += violations(value, one, at)
    if "not" in schema and not violations(value, schema["not"], at):
        out.append(f"{at}: excluded")
    return out


def violations(value, schema, at: str = "$") -> list[str]:
    """What the schema objects to, in a fixed order."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    if not isinstance(schema, dict):
        return [f"{at}: unsupported schema"]
    out = [f"{at}: unsupported {k}" for k in sorted(schema.keys() - APPLIED - DESCRIPTIVE)]
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    strange = [k for k in kinds if not isinstance(k, str) or k not in TYPES]
    if strange:
        return [*out, f"{at}: unsupported type"]
    if kinds and not any(is_type(value, k) for k in kinds):
        return [*out, f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]):
        out.append(f"{at}: not in enum")
    if "const" in schema and not same(value, schema["const"]):
        out.append(f"{at}: not the constant")
    out += combined(value, schema, at)
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif more is False:
                out.append(f"{at}.{k}: unknown")
            else:
                out += violations(value[k], more, f"{at}.{k}")
    elif isinstance(value, list):
        for i, x in enumerate(value):
            out += violations(x, schema.get("items", True), f"{at}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
        if "pattern" in schema:
            try:
                if not re.search(schema["pattern"], value):
                    out.append(f"{at}: not of the pattern")
            except (re.error, TypeError):
                out.append(f"{at}: unsupported pattern")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    return out


def checked(value, schema) -> list[str]:
    """``violations``; a schema whose own members have the wrong types is named instead of raised."""
    try:
        return violations(value, schema)
    except (TypeError, AttributeError, ValueError):
        return ["$: unsupported schema"]
    except RecursionError:
        return ["$: too deep"]


def parse(text: str | None):
    """The value of a JSON text.

    ValueError also for repeated keys, NaN, infinities and numbers too large for a double, half
    surrogates, which no text can hold, and values nested too deep to be written again.
    """

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def constant(name):
        raise ValueError(name)

    def number(digits):
        value = float(digits)
        if value in (float("inf"), float("-inf")):
            raise ValueError(digits)
        return value

    if text is None:
        raise ValueError("null")
    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_constant=constant, parse_float=number)
        canonical(value).encode("utf-8")
    except RecursionError:
        raise ValueError("too deep") from None
    return value


def canonical(value) -> str:
    """One text for equal values: sorted keys, no white space, whole floats as integers."""

    def plain(v):
        if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def once(df: DataFrame, *rest: str) -> DataFrame:
    """One row for each (conv_id, call_id), the least by turn and text; rows without both stay."""
    known = df.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first = known.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", *rest)).alias("s"), F.count(F.lit(1)).alias("n_copies"))
    loose = df.filter(F.col("conv_id").isNull() | F.col("call_id").isNull())
    return first.select("conv_id", "call_id", "s.*", "n_copies").union(
        loose.select("conv_id", "call_id", "turn", *rest, F.lit(1).cast("long")))


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, missing_parent): calls before each along ``after``; null in or after a cycle."""
    nodes = calls.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    parent = nodes.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there"))
    start = nodes.join(parent, ["conv_id", "after"], "left").select(
        "conv_id", "call_id",
        F.when(F.col("there"), F.col("after")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"),
        (F.col("after").isNotNull() & F.col("there").isNull()).alias("missing_parent"))
    now = stash(start, "jumps")
    reach, total = 1, now.count()
    while reach <= total and not now.filter(F.col("up").isNotNull()).isEmpty():
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        now = stash(now.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("up2").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), "missing_parent"), "jumps")
        reach *= 2
    return now.select(
        "conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "missing_parent")


def positions(rows: DataFrame) -> DataFrame:
    """Add ``position``, gapless from 0 in each conversation, by depth, turn and id.

    Ranks are taken within (depth, ``TURNS`` turns); the numbers of rows before each such part
    are summed over the parts alone.
    """
    order = F.coalesce("depth", F.lit(2**62))
    parted = rows.withColumn("_d", order).withColumn("_t", F.floor(F.coalesce("turn", F.lit(2**62)) / TURNS))
    counts = parted.groupBy("conv_id", "_d", "_t").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_d", "_t").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("conv_id", "_d", "_t").orderBy(
        F.col("turn").asc_nulls_last(), F.col("call_id").asc_nulls_last(), "message"))
    ranked = parted.withColumn("_rank", rank)
    same = (ranked["conv_id"].eqNullSafe(counts["conv_id"])) & (ranked["_d"] == counts["_d"]) & (ranked["_t"] == counts["_t"])
    return ranked.join(counts, same).select(
        *(ranked[c] for c in rows.columns), (counts["_before"] + ranked["_rank"] - 1).alias("position"))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One row per call, and one per result without a call, in topological order.

    ``others`` are finished messages that get their positions among the rest.
    """
    calls = once(calls.select("conv_id", "call_id", "turn", "after", "name", "arguments"), "after", "name", "arguments")
    results = once(results.select("conv_id", "call_id", "turn", "content"), "content")
    tools = {r["name"]: json.loads(r["schema"]) for r in schemas.select("name", "schema").collect()}  # one row per tool
    placed = calls.join(depths(calls), ["conv_id", "call_id"], "left")
    met = placed.alias("c").join(
        results.alias("r"), (F.col("c.conv_id") == F.col("r.conv_id")) & (F.col("c.call_id") == F.col("r.call_id")), "full")
    called = F.col("c.n_copies").isNotNull()
    joined = met.select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"), F.coalesce("c.call_id", "r.call_id").alias("call_id"),
        F.coalesce("c.turn", "r.turn").alias("turn"),
        F.when(~called, "orphan").when(F.col("r.n_copies").isNull(), "unanswered").otherwise("linked").alias("status"),
        F.col("c.depth").alias("depth"), F.coalesce("c.n_copies", "r.n_copies").alias("n_copies"),
        F.coalesce("c.missing_parent", F.lit(False)).alias("missing_parent"),
        F.col("c.after").alias("after"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"),
        F.col("r.content").alias("content"))

    def serialise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = lambda v: None if v is None or v != v else v
        for batch in batches:
            errors, messages = [], []
            for r in batch.itertuples(index=False):
                wrong, value = [], None
                if r.status != "orphan":
                    try:
                        value = parse(none(r.arguments))
                    except ValueError:
                        wrong.append("bad_json")
                    else:
                        wrong += checked(value, tools[r.name]) if r.name in tools else ["unknown_tool"]
                    if r.missing_parent:
                        wrong.append("missing_parent")
                    if none(r.depth) is None and none(r.conv_id) is not None and none(r.call_id) is not None:
                        wrong.append("cycle")
                body = {"id": none(r.call_id), "result": none(r.content), "status": r.status}
                if r.status != "orphan":
                    body |= {"name": none(r.name), "arguments": value, "after": none(r.after)}
                errors.append(";".join(wrong))
                messages.append(canonical(body))
            yield batch.assign(valid=[not e for e in errors], errors=errors, message=messages)[
                ["conv_id", "call_id", "turn", "status", "depth", "n_copies", "valid", "errors", "message"]]

    kind = dict(joined.dtypes)["conv_id"]
    done = shipped(joined).mapInPandas(
        serialise, f"conv_id {kind}, call_id string, turn long, status string, depth long, n_copies long, "
        "valid boolean, errors string, message string")
    return positions(stash(done.unionByName(others) if others is not None else done, "linked-calls"))


#: The tool that ``from_conversations`` makes of a user's turn (its schema's limits are parameters).
ASK = json.dumps({
    "type": "object", "required": ["text", "turn", "words"], "additionalProperties": False,
    "properties": {
        "text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0},
        "words": {"type": "integer", "minimum": 5}}})


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain chats: a user's turn calls ``ask``, the next turn answers it.

    A call follows the conversation's call two turns before. The id is made of the turn's number,
    so linking is an equi-join by id and needs no ordering of the conversation.
    """
    def ident(turn):
        return F.concat(F.lit("call-"), turn.cast("string"))

    turn = F.col("turn")
    asked = turns.filter(F.col("role") == "user")
    calls = asked.select(
        "conv_id", ident(turn).alias("call_id"), "turn",
        F.when(turn > 1, ident(turn - 2)).alias("after"), F.lit("ask").alias("name"),
        F.to_json(F.struct(
            F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^ \t-\r]+"), F.lit(0))).alias("words"),
            "turn", "text")).alias("arguments"))
    results = turns.filter(F.col("role") == "assistant").select(
        "conv_id", ident(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def context_turns(turns: DataFrame) -> DataFrame:
    """Messages of the turns of other roles or none, system and tool turns among them, one a row.

    They have the status ``context``, no call id and no depth; repeated rows stay.
    """
    other = turns.filter(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False)))
    kind = dict(turns.dtypes)["conv_id"]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(message=[
                canonical({"role": role, "status": "context", "text": text}) for role, text in zip(batch["role"], batch["text"])])[
                ["conv_id", "turn", "message"]]

    rows = shipped(other).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").mapInPandas(
        write, f"conv_id {kind}, turn long, message string")
    return rows.select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), "turn", F.lit("context").alias("status"),
        F.lit(None).cast("long").alias("depth"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("valid"),
        F.lit("").alias("errors"), "message")


def link_conversations(turns: DataFrame, whole: bool = False) -> DataFrame:
    """The calls and results of plain chats; with ``whole`` all other turns as well.

    Those have no depth, so they stand behind the calls of their conversation, in the order of turns.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    calls, results = from_conversations(turns)
    schemas = turns.sparkSession.createDataFrame([("ask", ASK)], "name string, schema string")
    return link(calls, results, schemas, context_turns(turns) if whole else None)
