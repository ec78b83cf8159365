"""Contracts over nested types, by version and by position."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import contracts
from changeflow.operators.asof import asof_join

NESTED = (
    "q int, price decimal(10,2), at timestamp, day date, tags array<string>, counts map<string, smallint>, "
    "address struct<city: string, zip: struct<code: int>>"
)
GOOD = {
    "q": "3", "price": "12.5", "at": '"2026-08-12T12:00:00Z"', "day": '"2026-08-12"', "tags": '["a"]', "counts": '{"x":1}',
    "address": '{"city":"B","zip":{"code":1}}',
}


def verdicts(spark, contract, values):
    text = "{" + ",".join(f'"{k}":{v}' for k, v in values.items()) + "}"
    df = spark.createDataFrame([("s", text)], "subject string, value string")
    return {r.field: r.verdict for r in contracts.conformance(df, {"s": contract}).collect() if r.verdict != "ok"}


@pytest.mark.parametrize(
    "field, text, verdict",
    [
        ("q", "3000000000", "out_of_range"), ("q", "3.5", "type_mismatch"), ("q", "1e400", "type_mismatch"), ("q", "null", None),
        ("price", "99999999.99", None), ("price", "100000000", "out_of_range"), ("price", "1.005", "out_of_range"),
        ("price", '"1"', "type_mismatch"), ("price", "7", None), ("price", "1e2", "type_mismatch"),
        ("at", '"yesterday"', "type_mismatch"), ("at", "5", "type_mismatch"), ("at", '"2026-08-12"', None),
        ("day", '"2026-13-01"', "type_mismatch"), ("day", "true", "type_mismatch"),
        ("tags", '["a",1]', "type_mismatch"), ("tags", "[]", None), ("tags", "[null]", None), ("tags", '{"a":1}', "type_mismatch"),
        ("counts", '{"x":40000}', "out_of_range"), ("counts", '{"x":"1","y":40000}', "type_mismatch"), ("counts", "{}", None),
        ("address", '{"city":"B"}', "type_mismatch"), ("address", '{"city":"B","zip":{"code":3000000000}}', "out_of_range"),
        ("address", '{"city":"B","zip":null,"more":1}', None), ("address", "[1]", "type_mismatch"),
    ],
)
def test_nested_verdicts(spark, field, text, verdict):
    assert verdicts(spark, NESTED, GOOD | {field: text}) == ({field: verdict} if verdict else {})


def test_missing_and_null_payloads(spark):
    assert verdicts(spark, NESTED, {k: v for k, v in GOOD.items() if k != "tags"} | {"new": "1"}) == {"tags": "missing", "new": "extra"}
    df = spark.createDataFrame([("s", None), ("s", '"text"'), ("s", ""), (None, "{}")], "subject string, value string")
    got = {(r.subject, r.verdict): r.n for r in contracts.conformance(df, {"s": "q int"}).collect()}
    assert got == {("s", "unreadable"): 3, (None, "unchecked"): 1}
    assert contracts.conformance(df.where("false"), {"s": "q int"}).isEmpty()
    assert {r.verdict for r in contracts.conformance(df, {}).collect()} == {"unchecked"}


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("s", "{}")], "subject string, value string")
    plan = contracts.with_verdicts(df, {"s": NESTED})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1 and "json_object_keys" not in plan


def test_unknown_types_are_refused_by_name():
    for contract, says in (("a binary", "a: no rule for binary"), ("a array<struct<b: void>>", r"a\[\].b: no rule for void"), ("a map<int, int>", "a: no rule for map")):
        with pytest.raises(contracts.ContractViolation, match=says):
            contracts.backward_differences(contract, contract)


@pytest.mark.parametrize(
    "old, new, found",
    [
        ("a struct<b: int>", "a struct<b: bigint>", []),
        ("a struct<b: int, c: string>", "a struct<b: int>", []),
        ("a struct<b: int>", "a struct<b: int, c: string>", ["a.c added without default"]),
        ("a struct<b: array<int>>", "a struct<b: array<string>>", ["a.b[] changed from int to string"]),
        ("a map<string, struct<x: float>>", "a map<string, struct<x: int>>", ["a{}.x changed from float to int"]),
        ("a decimal(10,2)", "a decimal(12,2)", ["a changed from decimal(10,2) to decimal(12,2)"]),
        ("a timestamp", "a date", ["a changed from timestamp to date"]),
        ("a int", "a array<int>", ["a changed from int to array<int>"]),
        ("a array<int>, b int", "a array<bigint>, c date, b boolean", ["c added without default", "b changed from int to boolean"]),
    ],
)
def test_nested_compatibility(old, new, found):
    assert contracts.backward_differences(old, new) == found


def test_default_by_path():
    assert contracts.backward_differences("a array<struct<b: int>>", "a array<struct<b: int, c: date>>", ("a[].c",)) == []


@pytest.fixture
def registry(spark):
    return contracts.empty_registry(spark)


def test_registration_decides(spark, registry):
    """An integer price becomes a decimal, then a boolean: refused where the subject's rule is BACKWARD."""
    one = contracts.register(registry, "s", 10, "id bigint, price int")
    assert [tuple(r) for r in one.collect()] == [("s", 1, 10, "BACKWARD", "id bigint, price int")]
    for worse in ("decimal(10,2)", "boolean"):
        with pytest.raises(contracts.ContractViolation, match="s: price changed from int"):
            contracts.register(one, "s", 20, f"id bigint, price {worse}")
    with pytest.raises(contracts.ContractViolation, match="holds from 10"):
        contracts.register(one, "s", 10, "id bigint, price bigint")
    with pytest.raises(ValueError, match="none of"):
        contracts.register(one, "s", 20, "id bigint", "FORWARD")
    two = one.unionByName(contracts.register(one, "s", 20, "id bigint, price decimal(10,2)", "NONE"))
    three = two.unionByName(contracts.register(two, "s", 30, "price boolean"))
    assert [(r.version, r.rule) for r in three.orderBy("version").collect()] == [(1, "BACKWARD"), (2, "NONE"), (3, "NONE")]
    assert contracts.register(three, "t", 0, "id int").first().version == 1


@pytest.mark.parametrize("width", [1, 7, 10**6])
def test_asof_equals_a_look_back(spark, width):
    random.seed(width)
    versions = [(random.choice("abc"), random.randint(-50, 300), i) for i in range(25)] + [(None, 3, 99), ("a", None, 98)]
    events = [(random.choice(["a", "a", "b", "c", "d", None]), random.choice([None, *range(-60, 320)]), i) for i in range(400)]
    got = asof_join(
        spark.createDataFrame(events, "key string, position bigint, id int"),
        spark.createDataFrame(versions, "key string, since bigint, version int"),
        "key", "position", "since", ["version"], width,
    )
    assert got.columns == ["key", "position", "id", "version"]

    def last(key, at):
        known = [(s, v) for k, s, v in versions if k is not None and k == key and s is not None and at is not None and s <= at]
        return max(known)[1] if known else None

    assert {r.id: r.version for r in got.collect()} == {i: last(k, p) for k, p, i in events}
    assert got.count() == len(events)


def test_one_subject_is_spread_over_its_stretches(spark):
    events = spark.range(20_000).selectExpr("'s' AS subject", "id AS position", "'{}' AS value")
    versions = spark.createDataFrame([("s", 0, 1), ("s", 12_345, 2)], "subject string, valid_from bigint, version int")
    got = asof_join(events, versions, "subject", "position", "valid_from", ["version"], 500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) > 4 and max(sizes) < 10_000
    assert {r.version: r["count"] for r in got.groupBy("version").count().collect()} == {1: 12_345, 2: 7_655}


def test_no_versions(spark, registry):
    rows = spark.createDataFrame([("s", 1, "{}"), (None, 2, "{}")], "subject string, position bigint, value string")
    got = contracts.versioned_conformance(rows, registry, 100).collect()
    assert sorted(str(r.subject) for r in got) == ["None", "s"] and {(r.version, r.verdict) for r in got} == {(None, "unchecked")}
