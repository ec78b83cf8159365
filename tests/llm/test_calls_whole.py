"""Calls hold whole questions."""

import json

from changeflow.llm import tool_calls


def test_arguments_hold_the_whole_question(spark):
    text = 'a long "question" ' * 200
    rows = [(1, 0, "user", text), (1, 1, "assistant", "b")]
    made = tool_calls.with_calls(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert json.loads(made.where("turn = 0").first().calls[0].arguments)["query"] == text
    found = json.loads(tool_calls.formatted(made, tool_calls.SCHEMAS).first().document)
    assert found["tool_calls"][0]["arguments"]["query"] == text
