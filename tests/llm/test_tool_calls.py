"""Tool-call linking against a plain version, and its odd cases."""

import json
import re
from collections import Counter, defaultdict

import pytest

from barsmith.llm import tool_calls as tc
from barsmith.llm.queries import op2_tool_call_linking

SF = "/root/testdata/sf0.001"
CALLS = "conv_id long, call_id string, after string, turn long, name string, arguments string, message string"
RESULTS = "conv_id long, call_id string, turn long, content string"
SCHEMAS = "name string, schema string"


def test_conversations_equal_a_plain_version(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    got = defaultdict(dict)
    for r in tc.link_conversations(turns).collect():
        got[r["conv_id"]][r["position"]] = r
    convs = defaultdict(dict)
    for r in turns.collect():
        convs[r["conv_id"]][r["turn"]] = r
    for conv, by_turn in convs.items():
        calls = {t for t, r in by_turn.items() if r["role"] == "user"}
        results = {t - 1 for t, r in by_turn.items() if r["role"] == "assistant"}
        want = []
        for t in sorted(calls | results):
            depth = None
            if t in calls:
                depth = 0
                while t - 2 * (depth + 1) in calls:
                    depth += 1
            status = "linked" if t in calls and t in results else "unanswered" if t in calls else "orphan"
            want.append((float("inf") if depth is None else depth, t, status))
        rows = [got[conv][k] for k in range(len(got[conv]))]
        assert [(float("inf") if r["depth"] is None else r["depth"], r["turn"] - (r["status"] == "orphan"), r["status"]) for r in rows] == sorted(want)
        for r in rows:
            message = json.loads(r["message"])
            assert message["status"] == r["status"]
            if r["status"] != "orphan":
                text = by_turn[r["turn"]]["text"]
                n = len(re.findall(r"[^\x20\x09-\x0D]+", text))
                assert message["arguments"] == {"text": text, "turn": r["turn"], "words": n}
                assert ("$.words: too small" in r["errors"]) == (n < 5)
            if r["status"] == "linked":
                assert message["result"] == by_turn[r["turn"] + 1]["text"]


def test_order_cycles_copies_and_nulls(spark):
    calls = spark.createDataFrame([
        (1, "c", "b", 0, "f", '{"x": 2.0, "a": [1, {"z": 1, "b": null}]}', "m"),
        (1, "b", "a", 5, "f", '{"x": 1}', "m"), (1, "a", None, 9, "f", '{"x": "1"}', "m"),
        (1, "a", None, 9, "f", '{"x": "1"}', "m"),
        (1, "p", "q", 1, "f", "{}", "m"), (1, "q", "p", 2, "g", '{"x": 1, "x": 2}', "m"), (1, "r", "q", 3, "f", None, "m"),
        (1, "s", "gone", 4, "f", '{"x": NaN}', "m"), (None, "a", None, 0, "f", '{"x": 1}', "m"), (2, None, None, 1, "f", '{"x": 1}', "m"),
    ], CALLS)
    results = spark.createDataFrame([(1, "a", 10, None), (1, "c", 2, "yes"), (1, "zz", 3, "lost"), (None, "a", 0, "x"), (2, None, 1, "y")], RESULTS)
    schema = json.dumps({"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "maximum": 2}}})
    rows = tc.link(calls, results, spark.createDataFrame([("f", schema)], SCHEMAS)).collect()
    got = {r["call_id"]: r for r in rows if r["conv_id"] == 1}
    assert [got[k]["depth"] for k in "abcs"] == [0, 1, 2, 0]
    assert [got[k]["depth"] for k in "pqr"] == [None] * 3
    assert [r["call_id"] for r in sorted(got.values(), key=lambda r: r["position"])] == ["s", "a", "b", "c", "p", "q", "r", "zz"]
    assert {k: got[k]["errors"] for k in got} == {
        "a": "$.x: not integer", "b": "", "c": "", "p": "$.x: missing;cycle", "q": "bad_json;cycle",
        "r": "bad_json;cycle", "s": "bad_json;missing_parent", "zz": ""}
    assert got["a"]["n_copies"] == 2 and got["a"]["status"] == "linked" and got["b"]["status"] == "unanswered"
    assert got["c"]["message"] == '{"after":"b","arguments":{"a":[1,{"b":null,"z":1}],"x":2},"id":"c","name":"f","result":"yes","status":"linked"}'
    assert got["zz"]["message"] == '{"id":"zz","result":"lost","status":"orphan"}'
    loose = sorted((str(r["conv_id"]), str(r["call_id"]), r["status"]) for r in rows if r["conv_id"] != 1)
    assert loose == [("2", "None", "orphan"), ("2", "None", "unanswered"), ("None", "a", "orphan"), ("None", "a", "unanswered")]
    empty = tc.link(calls.limit(0), results.limit(0), spark.createDataFrame([], SCHEMAS))
    assert empty.count() == 0


def test_long_chain_takes_few_rounds_and_keeps_order(spark):
    n = 700
    calls = spark.range(n).selectExpr(
        "7L as conv_id", "cast(id as string) as call_id", "if(id > 0, cast(id - 1 as string), null) as after",
        f"{n} - id as turn", "'f' as name", "'{}' as arguments")
    results = spark.createDataFrame([], RESULTS)
    rows = tc.link(calls, results, spark.createDataFrame([("f", "{}")], SCHEMAS)).collect()
    assert sorted((r["position"], int(r["call_id"]), r["depth"]) for r in rows) == [(k, k, k) for k in range(n)]


@pytest.mark.parametrize("value, schema, want", [
    (True, {"type": "integer"}, ["$: not integer"]), (3.0, {"type": "integer"}, []), ("ab", {"maxLength": 1}, ["$: too long"]),
    ([1, "x"], {"items": {"type": "number"}}, ["$[1]: not number"]), ("c", {"enum": ["a"]}, ["$: not in enum"]),
    ({"k": 1}, {"additionalProperties": False}, ["$.k: unknown"]), (1, {"minimum": 2}, ["$: too small"]),
    (None, {"type": ["string", "null"]}, []), (1, {"type": ["string", "null"]}, ["$: not string or null"]),
    (1, {"type": "int64"}, ["$: unsupported type"]), (1, {"type": {}}, ["$: unsupported type"]),
    ([1], {"items": False}, ["$[0]: not allowed"]), ({"k": 1}, {"additionalProperties": {"type": "string"}}, ["$.k: not string"]),
    (True, {"enum": [1]}, ["$: not in enum"]), ([1.0], {"enum": [[1]]}, []), ({"a": [True]}, {"const": {"a": [1]}}, ["$: not the constant"]),
    (5, {"anyOf": [{"type": "string"}, {"minimum": 6}]}, ["$: none of anyOf"]), (7, {"anyOf": [{"type": "string"}, {"minimum": 6}]}, []),
    (7, {"oneOf": [{"minimum": 1}, {"minimum": 6}]}, ["$: not one of oneOf"]), (7, {"allOf": [{"minimum": 8}]}, ["$: too small"]),
    ("a", {"not": {"type": "string"}}, ["$: excluded"]), ("abc", {"pattern": "^b"}, ["$: not of the pattern"]), ("abc", {"pattern": "b"}, []),
    ("a", {"pattern": "("}, ["$: unsupported pattern"]), (1, {"$ref": "#/x", "title": "t"}, ["$: unsupported $ref"]),
    ("a", {"minLength": "3"}, ["$: unsupported schema"]), (1, 5, ["$: unsupported schema"]), ({}, {"properties": [], "required": 3}, ["$: unsupported schema"]),
])
def test_schema_rules(value, schema, want):
    assert tc.checked(value, schema) == want


@pytest.mark.parametrize("text", [
    '["\\ud800"]', "1e999", "-1e999", "[" * 1500 + "]" * 1500, "[" * 100_000 + "]" * 100_000, "NaN", '{"a":1,"a":1}', "", "{", None])
def test_arguments_that_cannot_be_written_are_bad_json(text):
    with pytest.raises(ValueError):
        tc.parse(text)


def test_odd_arguments_do_not_end_a_task(spark):
    odd = ['{"x": "\\ud800"}', '{"x": 1e999}', '{"x": ' + "[" * 3000 + "]" * 3000 + "}", '{"x": "' + "long " * 300_000 + '"}', "[]"]
    calls = spark.createDataFrame([(1, f"c{i}", None, i, "f", a, "m") for i, a in enumerate(odd)], CALLS)
    schemas = spark.createDataFrame([("f", '{"type": ["object", "null"], "properties": {"x": {"type": "string", "pattern": "g"}}}')], SCHEMAS)
    got = {r["call_id"]: r for r in tc.link(calls, spark.createDataFrame([], RESULTS), schemas).collect()}
    assert [got[f"c{i}"]["errors"] for i in range(5)] == ["bad_json", "bad_json", "bad_json", "", "$: not object or null"]
    assert json.loads(got["c3"]["message"])["arguments"]["x"] == "long " * 300_000


def test_query_holds_every_turn_once(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(9001, 0, "tool", "t"), (9001, 1, None, "n"), (9001, 1, None, "n"), (9001, 2, "user", "u"), (9002, None, "system", None), (None, 0, "system", "s")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = op2_tool_call_linking(spark, str(tmp_path)).collect()
    held, places = Counter(), defaultdict(list)
    for r in got:
        message = json.loads(r["message"])
        places[r["conv_id"]].append(r["position"])
        if r["status"] == "context":
            held[r["conv_id"], r["turn"], message["role"], message["text"]] += 1
        if r["status"] in ("linked", "unanswered"):
            held[r["conv_id"], r["turn"], "user", message["arguments"]["text"]] += 1
        if r["status"] in ("linked", "orphan"):
            held[r["conv_id"], r["turn"] + (r["status"] == "linked"), "assistant", message["result"]] += 1
    assert held == Counter(rows)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert [r["status"] for r in sorted((r for r in got if r["conv_id"] == 9001), key=lambda r: r["position"])] == ["unanswered"] + ["context"] * 3
