"""Checks, contracts, parsing and percentiles against brute force."""

import datetime
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.iso8601 import parse_iso8601
from changeflow.functions.quantiles import exact_percentiles
from changeflow.operators import audit, contracts, runs
from changeflow.operators import expectations as ex
from changeflow.operators.evolve import union_versions
from changeflow.operators.reconcile import reconcile_markers
from changeflow.plans.checks import GOLD_CHECKS
from changeflow.sources.decode import decode_envelopes, encode_envelopes
from changeflow.plans.shop import ORDERS, PRODUCTS, ShopTable
from shopdata import NOON, T0, event, log, seed

MART = "order_id bigint, customer_id bigint, status string, item_count bigint, total_amount_cents bigint"


def mart(spark, rows):
    return spark.createDataFrame(rows, MART)


def failures(report):
    return {(r.expectation, r.column): (r.evaluated, r.unexpected) for r in report.collect() if not r.success}


def test_clean_mart_passes(spark):
    report = ex.report(mart(spark, [(1, 1, "placed", 1, 5), (2, 1, None, 0, 0)]), GOLD_CHECKS)
    assert report.count() == 6 and not failures(report)
    assert ex.verdict(report).first().asDict() == {"success": True, "failed_expectations": 0}


def test_each_check_finds_its_rows(spark):
    rows = [
        (1, 1, "placed", 1, 5),
        (1, None, "shpped", -1, 5),
        (1, 2, "shpped", 0, -7),
        (None, 2, None, None, None),
        (None, 2, "Placed", 1, 1),
    ]
    report = ex.report(mart(spark, rows), GOLD_CHECKS)
    assert failures(report) == {
        ("not_null", "order_id"): (5, 2),
        ("unique", "order_id"): (3, 3),
        ("not_null", "customer_id"): (5, 1),
        ("in_set", "status"): (4, 3),
        ("between", "total_amount_cents"): (4, 1),
        ("between", "item_count"): (4, 1),
    }
    assert ex.verdict(report).first().asDict() == {"success": False, "failed_expectations": 6}
    sample = ex.unexpected_sample(mart(spark, rows), GOLD_CHECKS[3])
    assert [(r.value, r.n) for r in sample.collect()] == [("Placed", 1), ("shpped", 2)]


def test_empty_mart_passes(spark):
    report = ex.report(mart(spark, []), GOLD_CHECKS)
    assert report.count() == 6 and not failures(report)


def test_unique_counts_values_for_tests_and_rows_for_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (2, None), (3, None)], "k bigint, v string")
    got = {r.column: (r.unexpected, r.unexpected_values) for r in ex.measure(df, [ex.unique("k"), ex.unique("v")]).collect()}
    assert got == {"k": (3, 1), "v": (2, 1)}


def test_orphans_ignore_null(spark):
    child = ShopTable("child", "id", "", (), references=(("fk", "parent"), ("other", "parent")))
    declared = {"child": child, "parent": ShopTable("parent", "pk", "", ())}
    rows = [(1, 2), (1, 7), (2, 2), (9, 2), (9, None), (None, 2)]
    tables = {
        "child": spark.createDataFrame(rows, "fk bigint, other bigint"),
        "parent": spark.createDataFrame([(1,), (2,)], "pk bigint"),
    }

    def found():
        return {(r.child, r.fk): r.orphans for r in audit.fk_orphans(tables, declared).collect()}

    assert found() == {("child", "fk"): 2, ("child", "other"): 1}
    tables["child"] = tables["child"].where("false")
    assert found() == {("child", "fk"): 0, ("child", "other"): 0}


def test_shape_contract(spark):
    df = mart(spark, [(1, 1, "placed", 1, 5)])
    assert contracts.enforce_shape(df.select(*reversed(df.columns)), MART).columns == df.columns
    for broken, says in (
        (df.drop("status"), "missing status"),
        (df.withColumn("note", F.lit(1)), "extra note"),
        (df.withColumn("status", F.lit(1)), "status is int"),
        (df.withColumnRenamed("status", "state"), "missing status"),
    ):
        with pytest.raises(contracts.ContractViolation, match=says):
            contracts.enforce_shape(broken, MART)


def test_backward_compatibility():
    old = "id bigint, price int, name string"
    assert contracts.backward_differences(old, "id bigint, price bigint") == []
    assert contracts.backward_differences(old, "id bigint, price double, x string", ("x",)) == []
    assert contracts.backward_differences(old, "id bigint, price int, x string") == ["x added without default"]
    for worse in ("boolean", "decimal(10,2)", "string"):
        assert contracts.backward_differences(old, f"id bigint, price {worse}") == [
            f"price changed from int to {worse}"
        ]
    assert contracts.backward_differences("price double", "price float")


@pytest.mark.parametrize(
    "value, expected",
    [
        ('{"product_id":1,"sku":"a","name":"b","price_cents":3,"category":"c"}', {}),
        ('{"product_id":1,"sku":"a","name":"b","price_cents":"3","category":"c"}', {"price_cents": "type_mismatch"}),
        ('{"product_id":1,"sku":"a","name":"b","price_cents":3.5,"category":"c"}', {"price_cents": "type_mismatch"}),
        ('{"product_id":1,"sku":"a","name":"b","price_cents":true,"category":"c"}', {"price_cents": "type_mismatch"}),
        ('{"product_id":1,"sku":{"x":1},"name":["b"],"price_cents":3,"category":null}',
         {"sku": "type_mismatch", "name": "type_mismatch"}),
        ('{"product_id":1,"name":"b","price_cents":3,"category":"c","new":1}', {"sku": "missing", "new": "extra"}),
        ("[1]", {"*": "unreadable"}),
        ("{oops", {"*": "unreadable"}),
        (None, {"*": "unreadable"}),
    ],
)
def test_field_verdicts(spark, value, expected):
    df = spark.createDataFrame([("products", value), ("other", value)], "subject string, value string")
    got = {(r.subject, r.field): r.verdict for r in contracts.conformance(df, {"products": PRODUCTS.image}).collect()}
    assert got.pop(("other", "*")) == "unchecked"
    assert {f: v for (_, f), v in got.items() if v != "ok"} == expected


def test_quarantine_keeps_every_row(spark):
    good = '{"product_id":1,"sku":"a","name":"b","price_cents":3,"category":"c","more":1}'
    df = spark.createDataFrame([("products", good), ("products", "{"), ("other", "?")], "subject string, value string")
    got = {(r.subject, r.value): (r.verdict, r.field) for r in contracts.quarantine(df, {"products": PRODUCTS.image}).collect()}
    assert got == {
        ("products", good): ("accepted", "*"),
        ("products", "{"): ("quarantined", "*"),
        ("other", "?"): ("accepted", "*"),
    }


def test_castability(spark):
    df = spark.createDataFrame([("1", 1), ("x", None), (None, 3)], "a string, b bigint")
    got = {r.column: (r.expected, r.evaluated, r.not_castable) for r in contracts.castability(df, "a int, b bigint").collect()}
    assert got == {"a": ("int", 2, 1), "b": ("bigint", 2, 0)}


def test_fail_fast_decoding(spark):
    messages = encode_envelopes(seed(spark, "orders"), "order_id")
    assert decode_envelopes(messages, ORDERS.image).count() == 3
    for text in ('{"op":', "{", "", " ", "null", "[", '{"after":{"order_id":"x"}}'):
        poison = messages.unionByName(spark.createDataFrame([("9", text)], "key string, value string"))
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            decode_envelopes(poison, ORDERS.image).collect()
    assert decode_envelopes(poison, ORDERS.image, fail_fast=False).where("op IS NULL").count() == 1
    tombstone = messages.unionByName(spark.createDataFrame([("9", None)], "key string, value string"))
    assert decode_envelopes(tombstone, ORDERS.image).count() == 3


def test_decoding_restores_events(spark):
    events = seed(spark, "orders", [event("orders", "d", (1, 1, "placed", NOON, NOON), None, T0 + 1, 9)])
    decoded = decode_envelopes(encode_envelopes(events, "order_id"), ORDERS.image)
    assert sorted(map(repr, decoded.collect())) == sorted(map(repr, events.collect()))


UTC = datetime.timezone.utc


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2026-08-12T10:00:00Z", (2026, 8, 12, 10, 0)),
        ("2026-08-12T10:00:00.987654Z", (2026, 8, 12, 10, 0, 0, 987000)),
        ("2026-08-12T10:00:00+05:30", (2026, 8, 12, 4, 30)),
        ("2026-08-12T10:00-0800", (2026, 8, 12, 18, 0)),
        ("2026-08-12T10:00Z", (2026, 8, 12, 10, 0)),
        ("2026-08-12T10:00:00", (2026, 8, 12, 10, 0)),
        ("2026-08-12", (2026, 8, 12)),
        ("2024-02-29T00:00:00Z", (2024, 2, 29)),
        ("2026-02-30T10:00:00Z", None),
        ("2026-08-12T25:00:00Z", None),
        ("2026-08-12 10:00:00", None),
        ("T10:00:00", None),
        ("10:00", None),
        ("2026-W33-3", None),
        ("2026-224", None),
        ("20260812T100000Z", None),
        ("", None),
        (None, None),
    ],
)
def test_iso8601(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.unix_micros(parse_iso8601(F.col("t")))).first()[0]
    expected = wanted and int(datetime.datetime(*wanted, tzinfo=UTC).timestamp() * 1_000_000)
    assert got == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**40), 2**40) | st.integers(-3, 3), min_size=1, max_size=60))
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    got = exact_percentiles(df, "v", {"lo": 0.0, "mid": 0.5, "high": 0.95, "hi": 1.0}).first()
    want = np.percentile(np.array(values, dtype="float64"), [0, 50, 95, 100])
    assert np.allclose([got.lo, got.mid, got.high, got.hi], want, rtol=1e-12, atol=1e-6)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    assert exact_percentiles(df, "v", {"p": 0.5}).first().p is None


def test_percentiles_with_a_hot_value(spark):
    random.seed(3)
    values = [5] * 400 + [random.randrange(10**12) for _ in range(800)]
    got = exact_percentiles(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", {"p50": 0.5, "p95": 0.95}).first()
    assert np.allclose([got.p50, got.p95], np.percentile(values, [50, 95]))


def test_union_of_versions(spark):
    old = spark.createDataFrame([(1, 2, "x")], "k bigint, price int, brand string")
    new = spark.createDataFrame([(2, 2**40, "y")], "k bigint, price bigint, kind string")
    both = union_versions(old, new)
    assert both.schema == T.StructType.fromDDL("k bigint, price bigint, brand string, kind string")
    assert sorted(map(tuple, both.collect())) == [(1, 2, "x", None), (2, 2**40, None, "y")]
    with pytest.raises(ValueError, match="no common type"):
        union_versions(old, new.withColumn("price", F.lit("free")))


def test_marker_verdicts(spark):
    sent = [f"chaos-{i}@example.com" for i in range(4)]
    rows = [(i, m, "M", "ZZ", NOON) for i, m in enumerate(sent)]
    arrived = [event("customers", "c", None, rows[i]) for i in (0, 1, 1, 3)] + [
        event("customers", "d", rows[2], None),
        event("customers", "c", None, (8, "x@chaos-1", "M", "ZZ", NOON)),
    ]
    expected = spark.createDataFrame([(m, 1) for m in sent], "marker string, expected bigint")
    got = reconcile_markers(expected, log(spark, "customers", arrived), "email", "chaos-")
    assert {r.marker: r.verdict for r in got.collect()} == dict(zip(sent, ["ok", "duplicated", "lost", "ok"]))


def test_latest_status_keeps_jobs_apart(spark):
    rows = [
        ("build", "success", 1.0, 10, 1), ("build", "success", 0.0, 20, 2), ("build", "success", 1.0, 20, 3),
        ("build_orchestrated", "success", 0.0, 5, 9), ("build", "seconds", 4.5, 1, 1),
    ]
    df = spark.createDataFrame(rows, "job string, metric string, value double, at bigint, seq bigint").withColumn(
        "ts", F.timestamp_millis("at")
    )
    got = {(r.job, r.metric): r.value for r in runs.latest_status(df, "seq").collect()}
    assert got == {("build", "success"): 1.0, ("build_orchestrated", "success"): 0.0, ("build", "seconds"): 4.5}


def test_lag_never_negative(spark):
    ends = spark.createDataFrame(
        [("g", "t", 0, 10), ("g", "t", 1, 5), ("g", "u", 0, 3)], "grp string, topic string, partition int, end_offset bigint"
    )
    done = spark.createDataFrame(
        [("g", "t", 0, 4), ("g", "u", 0, 9)], "grp string, topic string, partition int, committed_offset bigint"
    )
    assert {r.topic: r.lag for r in runs.consumer_lag(ends, done).collect()} == {"t": 11, "u": 0}


def test_lag_of_a_stream_report(spark):
    report = {
        "sources": [
            {"latestOffset": {"t": {"0": 12, "1": 7}}, "endOffset": '{"t": {"0": 10}}'},
            {"latestOffset": '{"u": {"0": 3}}', "endOffset": {"u": {"0": 3}}},
            {"latestOffset": None, "endOffset": None},
        ]
    }
    lag = runs.consumer_lag(*runs.topic_offsets(spark, "g", report))
    assert {r.topic: r.lag for r in lag.collect()} == {"t": 9, "u": 0}
