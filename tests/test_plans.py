"""What the plans must and must not contain."""

import re

import pytest

from changeflow.plans import silver
from changeflow.plans.shop import ORDERS, TABLES
from changeflow.sources.envelope import envelope_schema
from changeflow.workload import QUERIES
from changeflow.workload.derive import bronze

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


TEXT = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "1000"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    for key, value in TEXT.items():
        spark.conf.set(key, value)
    yield
    for key in TEXT:
        spark.conf.unset(key)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert node not in text
    # rows meet in one task only as partial totals or as the winners of a top-k; a window without
    # partitions would need such an exchange too
    for line_no, line in enumerate(text.splitlines()):
        if "Exchange SinglePartition" in line:
            below = text.splitlines()[line_no + 1]
            assert re.search(r"Aggregate\(keys=\[\], functions=\[.*(partial|merge)_", below), below


@pytest.mark.parametrize("name", sorted(TABLES))
def test_state_keeps_one_event_per_key_before_the_shuffle(spark, tmp_path, name):
    shop = TABLES[name]
    path = str(tmp_path / name)
    bronze(spark, "/root/testdata/sf0.001", name).write.parquet(path)
    stored = spark.read.schema(envelope_schema(shop.image)).parquet(path)
    text = plan(silver.silver(stored, shop))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert text.rindex("Partial") > text.index("Exchange")

    narrow = plan(silver.current_state(stored, shop.key, shop.columns[:1]))
    read = re.search(r"ReadSchema: (.*)", narrow).group(1)
    assert f"before:struct<{shop.key}:bigint>" in read and "source:struct<lsn:bigint>" in read
    assert all(c not in read for c in shop.columns[1:])


def test_mart_shuffles(spark, sf_dir, no_broadcast):
    """Three logs by their keys, items by order, orders and customers by salted customer, and the hot-key
    counts; joining order totals to orders reuses both partitionings."""
    text = plan(QUERIES["gold_order_summary"](spark, sf_dir))
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?(, salt)?", text)
    assert sorted(shuffles) == sorted(
        [
            ("order_id", ""),
            ("order_item_id", ""),
            ("customer_id", ""),
            ("order_id", ""),
            ("customer_id", ", salt"),
            ("customer_id", ", salt"),
            ("customer_id", ""),
            ("customer_id", ""),
            # the totals that the hot shares are taken of, planned once per use and run once
            *[("customer_id", "")] * 4,
        ]
    )


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_orphans_are_counted_without_a_join(spark, sf_dir, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        lines = plan(QUERIES["fk_orphans"](spark, sf_dir)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counted = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(link" in line]
    assert not any("Join [" in line for line in lines) and "partial_sum" in lines[counted[0] + 1]
    assert all("\n".join(lines).count(f"{t}.parquet") == 1 for t in ("customer", "orders", "part"))
    assert "\n".join(lines).count("lineitem.parquet") == 1


def test_markers_reach_the_scan_as_a_filter(spark, tmp_path):
    from changeflow.operators.reconcile import reconcile_markers

    path = str(tmp_path / "customers")
    bronze(spark, "/root/testdata/sf0.001", "customers").write.parquet(path)
    expected = spark.createDataFrame([("m", 1)], "marker string, expected bigint")
    text = plan(reconcile_markers(expected, spark.read.parquet(path), "email", "chaos-"))
    assert "StringStartsWith(after.email,chaos-)" in text


def test_include_list_reaches_the_scan(spark, tmp_path):
    from changeflow.sources.routing import include_tables

    path = str(tmp_path / "orders")
    bronze(spark, "/root/testdata/sf0.001", "orders").write.parquet(path)
    text = plan(include_tables(spark.read.parquet(path), ["orders"]).select("op"))
    assert "source.table" in re.search(r"PushedFilters: (.*)", text).group(1)
    assert ORDERS.columns[1] not in re.search(r"ReadSchema: (.*)", text).group(1)
