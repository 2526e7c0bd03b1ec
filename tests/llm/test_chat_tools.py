"""Tool-call linking: links, order, validation and canonical JSON."""

import json

from flyway.llm import chat_tools as C
from flyway.llm.common import table

MESSAGES = (f"conv_id bigint, turn bigint, role string, content string, tool_calls {C.CALLS}, "
            "tool_call_id string, key string, level int, json string")
TOOLS = [("add", "a", "integer", True, None, None), ("add", "b", "number", True, None, None),
         ("say", "text", "string", True, 2, 4), ("say", "opts", "object", False, None, None)]


def call(conv, turn, id, name, args, after=None):
    return (conv, turn, "assistant", None, [(id, name, args, after)], None, "k", 1, "j")


def result(conv, turn, id, text):
    return (conv, turn, "tool", text, None, id, "k", 1, "j")


def run(spark, rows):
    out = C.format_chat(spark.createDataFrame(rows, MESSAGES), spark.createDataFrame(TOOLS, C.SCHEMA))
    return out.collect()


def test_links_and_states(spark):
    got = run(spark, [
        call(1, 1, "x", "add", ' { "b" : 2.5, "a" : 1 } '), result(1, 2, "x", "3.5"),
        call(1, 3, "y", "add", '{"a":1,"b":2}', "x"), result(1, 9, "z", "lost"),
        call(2, 1, "x", "add", '{"a":1,"b":2}'), call(2, 1, "x", "add", '{"a":1,"b":2}'),
        call(2, 5, "x", "add", '{"a":7,"b":2}'), result(2, 6, "x", "late"), result(2, 4, "x", "early"),
        call(None, 1, "n", "add", None), result(None, 2, "n", None),
        (3, 0, "user", "hi", None, None, "k", 1, "j"), (3, 0, "user", "hi", None, None, "k", 1, "j"),
        (None,) * 9, call(3, 4, None, "add", "{}"), (3, 5, "user", "", [], None, "k", 1, "j")])
    by = {(r.conv_id, r.call_id): r for r in got if r.status != "message"}
    assert {k: (r.status, r.level, r.copies) for k, r in by.items()} == {
        (1, "x"): ("linked", 0, 2), (1, "y"): ("unanswered", 1, 1), (1, "z"): ("orphan", None, 1),
        (2, "x"): ("linked", 0, 5), (None, "n"): ("linked", 0, 2)}
    assert by[1, "x"].json == ('{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"3.5","status":"linked"}')
    assert by[2, "x"].json.count('"result":"early"') == 1 and json.loads(by[2, "x"].json)["arguments"]["a"] == 1
    assert by[None, "n"].errors == "arguments:not_json"
    assert sum(r.status == "message" for r in got) == 5


def test_validation(spark):
    cases = {'{"a":1,"b":2}': "", '{"a":"1","b":2}': "a:type", '{"a":1}': "b:missing", '[1]': "arguments:not_object",
             '{"a":1,"b":2,"c":{}}': "c:unknown", '{"a":1.5,"b":true}': "a:type,b:type", '{"a":1,': "arguments:not_json",
             '{"a":1,"a":2,"b":1}': "arguments:not_json", '{"a":null,"b":1}': "a:type"}
    rows = [call(1, i, f"c{i}", "add", a) for i, a in enumerate(cases)]
    says = {'{"text":"é"}': "text:short", '{"text":"12345"}': "text:long", '{"text":"ok","opts":{"z":1,"a":[{"y":1,"b":2}]}}': ""}
    rows += [call(2, i, f"c{i}", "say", a) for i, a in enumerate(says)] + [call(2, 9, "u", "none", "{}"),
                                                                          call(2, 10, "m", "say", '{"text":"ok"}', "gone")]
    got = {(r.conv_id, r.call_id): r for r in run(spark, rows)}
    assert [got[1, f"c{i}"].errors for i in range(len(cases))] == list(cases.values())
    assert [got[2, f"c{i}"].errors for i in range(len(says))] == list(says.values())
    assert all(r.valid == (r.errors == "") for r in got.values())
    assert got[2, "u"].errors == "tool:unknown" and got[2, "m"].errors == "after:missing"
    assert '{"opts":{"a":[{"b":2,"y":1}],"z":1},"text":"ok"}' in got[2, "c2"].json


def test_order_of_long_chains_and_cycles(spark):
    n = 150                                                   # written against the turns: last call first
    rows = [call(1, n - i, f"c{i}", "add", "{}", f"c{i - 1}" if i else None) for i in range(n)]
    rows += [call(2, i, f"c{i}", "add", "{}", f"c{(i + 1) % 3}") for i in range(3)] + [call(2, 9, "d", "add", "{}", "c0")]
    got = run(spark, rows)
    assert [r.call_id for r in got if r.conv_id == 1] == [f"c{i}" for i in range(n)]
    assert [r.level for r in got if r.conv_id == 1] == list(range(n))
    assert {r.status for r in got if r.conv_id == 2} == {"cyclic"}


def test_texts_unnamed_calls_and_repeats_stay(spark):
    calls = [("x", "add", '{"b":2,"a":1}', None), (None, "say", '{"text":"ok!"}', "x")]
    got = run(spark, [
        (1, 1, "assistant", "I add first.", calls, None, "k", 1, "j"), result(1, 2, "x", "3"),
        call(1, 3, None, "say", "{}"), (1, 4, "assistant", None, [], None, "k", 1, "j"),
        call(2, 1, "d", "add", "{}"), call(2, 2, "d", "add", "{}"), call(2, 3, "d", "say", '{"text":"ok"}'),
        call(2, 4, "d", "say", '{"text":"ok"}'), call(2, 5, "d", "add", "{}", "gone"), result(2, 6, "d", "r"),
        result(2, 7, "d", "s"), result(2, 8, "d", None), result(3, 1, "o", "p"), result(3, 2, "o", "q")])
    assert [(r.call_id, r.status, r.call_turn, r.name, r.errors, json.loads(r.json)) for r in got if r.conv_id == 1] == [
        ("x", "linked", 1, "add", "", {"arguments": {"a": 1, "b": 2}, "id": "x", "name": "add", "result": "3", "status": "linked"}),
        *sorted([(None, "message", 1, None, None, {"content": "I add first.", "role": "assistant"}),
                 (None, "message", 1, "say", "", {"after": "x", "arguments": {"text": "ok!"}, "name": "say", "role": "assistant"})],
                key=lambda r: [g.name for g in got if g.conv_id == 1].index(r[3])),
        (None, "message", 3, "say", "text:missing", {"arguments": {}, "name": "say", "role": "assistant"}),
        (None, "message", 4, None, None, {"role": "assistant"})]
    two = [r for r in got if r.conv_id == 2]
    assert (two[-1].status, two[-1].copies, json.loads(two[-1].json)["result"]) == ("linked", 8, "r")
    assert {r.level for r in two} == {0} and {
        (r.call_turn, r.result_turn, r.copies, r.errors, r.json) for r in two[:-1]} == {
        (3, None, 2, "", '{"arguments":{"text":"ok"},"id":"d","name":"say","status":"repeated"}'),
        (5, None, 1, "a:missing,b:missing,after:missing",
         '{"after":"gone","arguments":{},"id":"d","name":"add","status":"repeated"}'),
        (None, 7, 1, None, '{"id":"d","result":"s","status":"repeated"}'),
        (None, 8, 1, None, '{"id":"d","status":"repeated"}')}
    assert [(r.status, r.json) for r in got if r.conv_id == 3] == [
        ("repeated", '{"id":"o","result":"q","status":"repeated"}'), ("orphan", '{"id":"o","result":"p","status":"orphan"}')]


def test_empty(spark):
    assert run(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = C.format_chat(C.transcripts(table(spark, "/root/testdata/sf0.001", "conversations")), C.transcript_schemas(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
