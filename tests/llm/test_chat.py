import json

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from guestbook.llm import chat
from guestbook.llm.queries import TOOLS

MESSAGES = "conv_id long, turn long, role string, text string"
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>"
RESULTS = "conv_id long, call_id string, content string"

GOOD = '{"limit": 3, "query": "é\\n"}'


def made(spark, messages=(), calls=(), results=()):
    frames = (spark.createDataFrame(list(x), s) for x, s in ((messages, MESSAGES), (calls, CALLS), (results, RESULTS)))
    return chat.chats(*frames, TOOLS)


def test_links_orders_and_validates(spark):
    calls = [
        (1, 1, "a", "search", GOOD, ["b"]),
        (1, 2, "b", "search", '{"query": "", "limit": 51, "x": 1}', ["c", "nowhere"]),
        (1, 3, "c", "translate", '{"text": "t", "to": "xx"}', None),
        (1, 4, "d", "unheard", "{}", []),
        (1, 5, "e", "search", "no json", ["f"]),
        (1, 6, "f", "search", "[]", ["e"]),
        (1, 7, "a", "search", GOOD, []),
    ]
    results = [(1, "a", "ra"), (1, "a", "Ra"), (1, "z", "lost"), (1, "d", None)]
    row = made(spark, [(1, 0, "system", 'say "hi"'), (1, None, None, None)], calls, results).collect()[0]
    held = json.loads(row.chat)
    assert [call["id"] for call in held["tool_calls"]] == ["c", "b", "a", "d", "e", "f", "a"]
    by_id = {call["id"]: call for call in reversed(held["tool_calls"])}
    assert by_id["a"] == {"id": "a", "name": "search", "arguments": {"limit": 3, "query": "é\n"}, "errors": [], "result": "Ra"}
    assert by_id["b"]["errors"] == ["/limit is too large", "/query has a wrong length", "/x is unknown"]
    assert by_id["c"]["errors"] == ["/to is none of the choices"] and by_id["c"]["marks"] == ["pending"]
    assert by_id["d"]["errors"] == ["the tool is unknown"] and by_id["d"]["result"] == ""
    assert by_id["e"]["errors"] == ["/ is no JSON"] and by_id["e"]["arguments"] == "no json"
    assert by_id["f"]["errors"] == ["/ is no object"] and by_id["f"]["marks"] == ["cyclic", "pending"]
    assert held["orphans"] == [{"id": "z", "result": "lost"}]
    assert held["messages"] == [{"content": "", "role": "unknown"}, {"content": 'say "hi"', "role": "system"}]
    counts = row.asDict()
    assert {k: counts[k] for k in counts if k[:2] == "n_"} == {
        "n_messages": 2, "n_calls": 7, "n_linked": 2, "n_invalid": 5, "n_orphans": 1, "n_repeated": 2, "n_cyclic": 2,
    }


def test_json_is_canonical(spark):
    a = made(spark, calls=[(1, 1, "a", "search", '{"query":"q","limit":1}', [])]).collect()[0].chat
    b = made(spark, calls=[(1, 1, "a", "search", ' {"limit": 1, "query": "\\u0071"}', None)]).collect()[0].chat
    assert a == b == chat.canonical(json.loads(a))


def test_nulls_and_empty_tables(spark):
    assert made(spark).count() == 0
    got = made(
        spark,
        [(None, 1, "user", "x"), (None, 1, "user", "x"), (None, 2, "user", "y")],
        [(None, 1, None, None, None, None), (2, 1, None, "search", GOOD, None), (2, 1, None, "search", GOOD, None)],
        [(None, "a", "r"), (2, None, "r")],
    )
    assert sorted(row.n_messages for row in got.filter("conv_id is null").collect()) == [0, 0, 1, 2]
    two = got.filter("conv_id = 2").collect()[0]
    assert (two.n_calls, two.n_linked, two.n_orphans, two.n_repeated) == (2, 0, 1, 0)


def test_no_result_is_lost(spark):
    calls = [(1, 1, "a", "search", GOOD, [])]
    results = [(1, "a", x) for x in ("r1", "r1", "r2", None)] + [(1, "z", "o1"), (1, "z", "o2"), (1, "z", "o2")]
    results += [(1, None, x) for x in ("n1", "n2", "n2")] + [(None, None, "x"), (None, None, "y"), (None, "a", "v"), (None, "a", "w")]
    got = made(spark, calls=calls, results=results).collect()
    one = next(row for row in got if row.conv_id == 1)
    held = json.loads(one.chat)
    assert held["tool_calls"][0]["result"] == "r1"
    assert held["orphans"] == [{"id": None, "result": x} for x in ("n1", "n2", "n2")] + [{"id": "z", "result": "o1"}]
    assert held["repeated_results"] == [
        {"id": "a", "result": "", "copies": 1}, {"id": "a", "result": "r1", "copies": 1}, {"id": "a", "result": "r2", "copies": 1}, {"id": "z", "result": "o2", "copies": 2},
    ]
    assert (one.n_linked, one.n_orphans, one.n_repeated) == (1, 4, 5)
    alone = [json.loads(row.chat)["orphans"] for row in got if row.conv_id is None]
    assert sorted(x["result"] for orphans in alone for x in orphans) == ["v", "w", "x", "y"] and len(alone) == 4


def test_schema_rules():
    assert chat.problems(True, {"type": "integer"}) and chat.problems(1.5, {"type": "integer"})
    assert not chat.problems(1, {"type": "number", "minimum": 1, "maximum": 1})
    assert chat.problems([1, "x"], {"type": "array", "items": {"type": "number"}}) == ["/1 is no number"]
    assert chat.problems({}, {"type": "object", "required": ["a"]}) == ["/a is missing"]
    assert not chat.problems(None, {"type": "null"}) and not chat.problems({"a": 1}, {})


def test_numbers_beyond_json_are_no_json():
    assert chat.checked_arguments("search", '{"limit": NaN}', TOOLS)[1] == ["/ is no JSON"]
    assert chat.checked_arguments("search", None, TOOLS) == ("", ["/ is no JSON"])


def test_query_by_brute_force(spark):
    from __spark_entry__ import queries

    held = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    turns = {(row.conv_id, row.turn): row for row in held}
    got = {row.conv_id: row for row in queries()["op3_chat_format"](spark, SMALL).collect()}
    assert set(got) == {row.conv_id for row in held}
    for conv_id, row in got.items():
        calls = {t: x for (c, t), x in turns.items() if c == conv_id and x.role == "user"}
        found = json.loads(row.chat)
        assert [m["content"] for m in found["messages"]] == [x.text for (c, t), x in sorted(turns.items()) if c == conv_id and x.role == "system"]
        entries = {int(call["id"].rpartition("-")[2]): call for call in found["tool_calls"]}
        assert set(entries) == set(calls) and len(found["tool_calls"]) == len(calls)
        place = {int(call["id"].rpartition("-")[2]): n for n, call in enumerate(found["tool_calls"])}
        for turn, call in calls.items():
            n = len(call.text)
            answer = turns.get((conv_id, turn + 1))
            answer = answer.text if answer and answer.role == "assistant" else None
            assert entries[turn].get("result") == answer
            if n % 2 == 0:
                assert entries[turn]["arguments"] == {"query": call.text, "limit": n % 60}
                assert bool(entries[turn]["errors"]) == (not 1 <= n % 60 <= 50)
            else:
                assert bool(entries[turn]["errors"]) == (n % 5 == 4)
            need = {0: turn + 2, 1: turn - 2}.get(n % 4)
            if need in calls and "cyclic" not in entries[turn].get("marks", []):
                assert place[need] < place[turn]
        lost = [x for (c, t), x in turns.items() if c == conv_id and x.role == "assistant" and t - 1 not in calls]
        assert row.n_orphans == len(lost)
    assert len(rows(queries()["op3_chat_format"](spark, SMALL))) == len(got)


def test_arguments_that_no_file_can_hold_or_no_stack_can_read():
    schemas = {"t": {"type": "object", "properties": {"n": {"type": ["integer", "null"]}}}}
    half, deep = '{"query":"\\ud800"}', '{"a":' * 100_000 + "1" + "}" * 100_000
    assert chat.checked_arguments("t", half, schemas) == (half, ["/ is no JSON"])
    assert chat.checked_arguments("t", deep, schemas) == (deep, ["/ is too deep"])
    assert chat.checked_arguments("t", '{"n":null}', schemas) == ({"n": None}, [])
    assert chat.checked_arguments("t", '{"n":"1"}', schemas)[1] == ["/n is no integer or null"]
    assert chat.checked_arguments("t", '{"n":' + "9" * 5000 + "}", schemas)[1] == ["/ is no JSON"]  # beyond any float
    with pytest.raises(ValueError, match="pattern"):
        chat.check_schema({"type": "object", "properties": {"n": {"type": "string", "pattern": "x"}}})
    with pytest.raises(ValueError, match="no type"):
        chat.check_schema({"items": {"type": ["text"]}})


def test_bad_arguments_and_clashing_columns_reach_the_file(spark):
    calls = spark.createDataFrame([(1, 1, "a", "t", '{"q":"\\ud800"}', []), (1, 2, "b", "t", "[" * 50_000, None)], "conv_id long, turn int, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([(1, "a", None), (1, "a", "r1"), (1, "b", "x")], "conv_id long, call_id string, content string")
    messages = spark.createDataFrame([(1, 0, "system", "hello")], "conv_id long, turn int, role string, text string")
    clash = lambda df: df.withColumns({name: F.lit(name) for name in ("alone", "result", "copies", "message", "call", "called", "chat")})
    row = chat.chats(clash(messages), clash(calls), clash(results), {"t": {"type": "object"}}).collect()[0]
    held = json.loads(row.chat)
    assert [call["errors"] for call in held["tool_calls"]] == [["/ is no JSON"], ["/ is too deep"]]
    assert held["tool_calls"][0]["result"] == "r1" and held["repeated_results"] == [{"copies": 1, "id": "a", "result": ""}]
    assert (row.n_calls, row.n_linked, row.n_invalid, row.n_repeated) == (2, 2, 2, 1)
