"""Calls that no JSON can hold, schemas with unknown keywords, rows without identifiers."""

import json

import pytest
from pyspark.sql import functions as F

from changeflow.llm import tool_calls

MESSAGES = f"conv_id long, turn int, role string, text string, calls array<{tool_calls.CALL}>, result_of string"
SCHEMA = {"type": "object", "properties": {"limit": {"type": "number"}, "q": {"type": "string"}}}

BAD = ['{"limit":1e400}', "[" * 100_000, '{"q":"\\ud800"}', '{"limit":NaN}', '{"limit":-Infinity}', "{", '{"limit":' + "9" * 5000 + "}", '{"q":"' + "x" * 10]
GOOD = ['{"limit":1e300}', '{"limit":3.0}', '{"q":"\\ud83d\\ude00"}', "", None, '{"q":"é"}']


def conversation(conv, arguments):
    calls = [(f"c{i}", "find", a, None) for i, a in enumerate(arguments)]
    return [(conv, 0, "assistant", None, calls, None)] + [(conv, i + 1, "tool", f"r{i}", None, f"c{i}") for i in range(len(calls))]


def test_one_bad_call_spoils_no_other(spark):
    messages = spark.createDataFrame(conversation(1, BAD) + conversation(2, GOOD) + conversation(3, GOOD + BAD), MESSAGES)
    got = {r.conv_id: r for r in tool_calls.formatted(messages, {"find": SCHEMA}).collect()}
    assert {c: (r.n_ok, r.n_invalid) for c, r in got.items()} == {1: (0, len(BAD)), 2: (len(GOOD), 0), 3: (len(GOOD), len(BAD))}
    for call in json.loads(got[1].document)["tool_calls"]:
        assert call["errors"] == ["$: not JSON"] and call["arguments"] == BAD[int(call["id"][1:])]
    assert [c["arguments"] for c in json.loads(got[2].document)["tool_calls"]] == [{"limit": 1e300}, {"limit": 3}, {"q": "\U0001f600"}, {}, {}, {"q": "é"}]


@pytest.mark.parametrize(
    "schema, says",
    [
        ({"maxLength": 3}, r"\$: no check for maxLength"),
        ({"properties": {"q": {"anyOf": []}}}, r"\$.q: no check for anyOf"),
        ({"items": {"items": {"pattern": "x"}}}, r"\$\[\]\[\]: no check for pattern"),
        ({"type": ["string", "date"]}, r"\$: no type date"),
        ({"additionalProperties": {"type": "string"}}, "additionalProperties"),
    ],
)
def test_unknown_keywords_are_refused(spark, schema, says):
    messages = spark.createDataFrame(conversation(1, GOOD), MESSAGES)
    with pytest.raises(ValueError, match=says):
        tool_calls.formatted(messages, {"find": schema})


def test_rows_without_identifiers_link_with_nothing(spark):
    rows = [(None, 0, "assistant", None, [(None, "find", "{}", None)] * 2, None), (None, 1, "tool", "r", None, None)] * 3
    rows += [(1, 0, "assistant", None, [(None, "find", "{}", None), ("a", "find", "{}", None)], None), (1, 1, "tool", "r", None, "a")]
    rows += [(1, 2, "tool", "s", None, None)]
    messages = spark.createDataFrame(rows, MESSAGES).withColumn("nth", F.lit("x")).withColumn("apart", F.lit("y")).withColumn("status", F.lit(1))
    found = tool_calls.linked(messages).groupBy("conv_id", "status").count().collect()
    assert {(r.conv_id, r.status): r["count"] for r in found} == {(None, "unanswered"): 6, (None, "orphan"): 3, (1, "ok"): 1, (1, "unanswered"): 1, (1, "orphan"): 1}


def test_no_messages(spark):
    empty = spark.createDataFrame([], MESSAGES)
    assert tool_calls.linked(empty).isEmpty() and tool_calls.formatted(empty, {"find": SCHEMA}).isEmpty()
