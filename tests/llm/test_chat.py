import json

import pytest

from tessera.llm import chat, queries

EVENTS = "conv_id long, turn long, role string, text string, call_id string, after_id string, name string, arguments string, seq int, kind string"
TOOLS = {"f": [("a", "string", True), ("n", "integer", False), ("x", "number", False), ("o", "object", False), ("l", "array", False),
               ("b", "boolean", False)]}


def event(turn, role, call_id=None, after=None, name=None, arguments=None, text=None, conv=1):
    return (conv, turn, role, text, call_id, after, name, arguments, 0, "clash")


@pytest.fixture(scope="module")
def link(spark):
    def go(rows):
        got = chat.link_tool_calls(spark.createDataFrame(rows, EVENTS), chat.tool_table(spark, TOOLS)).collect()
        return sorted(got, key=lambda r: (str(r.conv_id), r.seq))
    return go


def test_dependencies_come_first(link):
    got = link([event(0, "user", text="hi"),
                event(1, "assistant", "c", "b", "f", '{"a":"x"}'),      # needs b, which is called later
                event(2, "assistant", "b", "a", "f", '{"a":"x"}'),
                event(3, "assistant", "a", None, "f", '{"a":"x"}'),
                event(4, "tool", "b"), event(5, "tool", "a"), event(6, "tool", "c"), event(7, "user", text="bye")])
    assert [(r.kind, r.call_id) for r in got] == [
        ("message", None), ("call", "a"), ("result", "a"), ("call", "b"), ("result", "b"), ("call", "c"), ("result", "c"), ("message", None)]
    assert [r.seq for r in got] == list(range(8))


def test_statuses(link):
    got = link([event(0, "assistant", "p", "q", "f", '{"a":"x"}'), event(1, "assistant", "q", "p", "f", '{"a":"x"}'),
                event(2, "assistant", "z", "p", "f", '{"a":"x"}'), event(3, "assistant", "u", "nowhere", "f", '{"a":"x"}'),
                event(4, "tool", "o"), event(5, "tool", "u"), event(6, "tool", "u"), event(7, "assistant", "u", None, "f", "{}"),
                event(8, "assistant", "w", None, "f", '{"a":"x"}'), event(8, "assistant", "w", None, "f", '{"a":"x"}'),
                event(5, "tool", "w", conv=2), event(None, "system", text="s"), event(1, "user", conv=None)])
    said = {(r.conv_id, r.turn, r.kind, r.call_id): r.status for r in got}
    assert said == {(1, 0, "call", "p"): "cycle", (1, 1, "call", "q"): "cycle", (1, 2, "call", "z"): "cycle",
                    (1, 3, "call", "u"): "linked", (1, 4, "result", "o"): "orphan", (1, 5, "result", "u"): "linked",
                    (1, 6, "result", "u"): "duplicate", (1, 7, "call", "u"): "duplicate", (1, 8, "call", "w"): "unanswered",
                    (2, 5, "result", "w"): "orphan", (1, None, "message", None): "message", (None, 1, "message", None): "message"}
    assert len(got) == 12       # the repeated row counts once
    assert [r.errors for r in got if r.call_id == "u" and r.turn == 3] == ["after"]


def test_validation(link):
    cases = {'{"a":"x","n":3,"x":1.5,"o":{},"l":[],"b":true}': "", '{"a":"x","x":2}': "", '{"a":1}': "type:a", "{}": "missing:a",
             '{"a":null}': "missing:a", '{"a":"x","q":1}': "extra:q", '{"a":"x","n":"3","b":1}': "type:b,type:n", "nope": "not an object",
             "[1]": "not an object", '{"a":"x","a":"y"}': "not an object", '{"a":"x","n":1.5}': "type:n"}
    rows = [event(k, "assistant", f"c{k}", None, "f", s) for k, s in enumerate(cases)]
    rows += [event(50, "assistant", "g", None, "g", "{}"), event(51, "assistant", "h", None, None, None)]
    got = link(rows)
    assert [r.errors for r in got] == [*cases.values(), "unknown tool", "unknown tool"]
    assert [r.valid for r in got] == [not e for e in cases.values()] + [False, False]


def test_canonical_json(link):
    got = link([event(0, "assistant", "c", None, "f", '{ "n" : 1.0, "a":"\\u00e9", "o":{"z":1,"y":[true,null]} }'), event(1, "tool", "c", text='say "hi"')])
    assert got[0].json == ('{"arguments":{"a":"é","n":1,"o":{"y":[true,null],"z":1}},"call_id":"c","kind":"call","name":"f",'
                           '"role":"assistant","seq":0,"status":"linked","turn":0}')
    for r in got:
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_long_chain_and_one_hot_conversation(link):
    n = 300
    rows = [event(k, "assistant", f"c{k}", f"c{k + 1}" if k + 1 < n else None, "f", '{"a":"x"}') for k in range(n)]
    got = link(rows)
    assert [r.call_id for r in got] == [f"c{k}" for k in range(n - 1, -1, -1)]


def test_empty(spark):
    none = spark.createDataFrame([], EVENTS)
    assert chat.link_tool_calls(none, chat.tool_table(spark, TOOLS)).count() == 0


def test_query_against_plain_python(spark):
    d = "/root/testdata/sf0.001"
    events = [r.asDict() for r in queries.conversation_events(spark.read.parquet(f"{d}/conversations.parquet")).collect()]
    calls = {(e["conv_id"], e["call_id"]): e for e in events if e["role"] == "assistant"}
    results = {(e["conv_id"], e["call_id"]): e for e in events if e["role"] == "tool"}

    def place(e):
        key = (e["conv_id"], e["call_id"])
        if e["role"] == "tool" and key in calls:
            t, d2 = place(calls[key])
            return max(t, e["turn"]), d2 + 1
        if e["role"] == "assistant":
            up = (e["conv_id"], e["after_id"])
            if up in calls:
                t, d2 = place(calls[up])
                return max(t, e["turn"], results[up]["turn"] if up in results else -1), d2 + 2
        return e["turn"], 0

    want = {}
    for e in sorted(events, key=lambda e: (e["conv_id"], *place(e), e["turn"])):
        want.setdefault(e["conv_id"], []).append(e["turn"])
    got = {}
    df = queries.op5_tool_calls(spark, d)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.seq)):
        got.setdefault(r.conv_id, []).append(r.turn)
        key = (r.conv_id, r.call_id)
        status = "message" if r.kind == "message" else ("linked" if key in calls and key in results else
                                                       "orphan" if r.kind == "result" else "unanswered")
        assert r.status == status and json.loads(r.json)["seq"] == r.seq
    assert got == want
