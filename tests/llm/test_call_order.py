"""The order of calls against its plain form, and at length."""

import json
import random
import time

from changeflow.llm import tool_calls


def plain(calls: list[dict]) -> tuple[list[dict], list[dict]]:
    """Again and again the first call, by turn and place, of those that wait for nothing."""
    ids = {c["call_id"] for c in calls}
    done, rest = [], sorted(calls, key=lambda c: (c["turn"], c["place"]))
    while True:
        named = {c["call_id"] for c in done}
        ready = next((c for c in rest if not {a for a in c["after"] or [] if a in ids} - named), None)
        if ready is None:
            return done, rest
        done.append(ready)
        rest.remove(ready)


def test_order_equals_its_plain_form():
    random.seed(23)
    for _ in range(300):
        n = random.randint(0, 12)
        names = [f"c{i}" for i in range(n)]
        calls = [
            {"call_id": c, "turn": random.randint(0, 4), "place": random.randint(0, 2), "after": random.choice([None, random.choices([*names, "none"], k=random.randint(0, 2))])}
            for c in names
        ]
        assert tool_calls.ordered(calls) == plain(calls)


def test_order_of_many_calls_is_linear():
    n = 40_000
    calls = [{"call_id": f"c{i}", "turn": n - i, "place": 0, "after": [f"c{i - 1}"]} for i in range(n)]
    random.Random(29).shuffle(calls)
    start = time.process_time()
    done, cyclic = tool_calls.ordered(calls)
    assert [c["call_id"] for c in done] == [f"c{i}" for i in range(n)] and not cyclic
    assert time.process_time() - start < 10


def test_calls_are_judged_one_row_each(spark):
    call = "array<struct<id: string, name: string, arguments: string, after: array<string>>>"
    rows = [
        (1, 0, "user", "q", [("a", "lookup", '{"limit": 2.0, "query": "long enough to be a query"}', ["b"]), ("b", "lookup", "no JSON", None), ("c", "other", None, None)], None),
        (1, 1, "tool", 'r "1"', None, "a"),
        (1, 2, "tool", None, None, "b"),
        (1, 3, "tool", "stray", None, "z"),
    ]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, calls {call}, result_of string")
    pieces = {r.call_id: r for r in tool_calls.judged(tool_calls.linked(messages), tool_calls.SCHEMAS).collect()}
    assert [pieces[c].invalid for c in "abcz"] == [False, True, None, None]
    found = tool_calls.formatted(messages, tool_calls.SCHEMAS).first()
    assert (found.n_calls, found.n_ok, found.n_unlinked, found.n_invalid, found.n_cyclic) == (3, 1, 2, 1, 0)
    document = json.loads(found.document)
    assert found.document == tool_calls.canonical(document)
    assert [(c["id"], c["valid"], c["result"]) for c in document["tool_calls"]] == [("b", False, ""), ("a", True, 'r "1"')]
    assert document["tool_calls"][1]["arguments"] == {"limit": 2, "query": "long enough to be a query"}
    assert document["messages"][1] == {"role": "tool", "content": 'r "1"', "tool_call_id": "a"}
