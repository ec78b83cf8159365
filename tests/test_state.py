"""Current state and the mart on the seed rows, and properties on the derived logs."""

import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators.skew import hot_keys, salted_left_join
from changeflow.plans import gold, silver
from changeflow.plans.shop import ORDER_ITEMS, ORDERS, TABLES
from changeflow.sources.capture import apply_changes, snapshot_diff
from changeflow.workload.derive import base_rows, bronze
from shopdata import NOON, T0, event, log, seed


def mart(spark, orders=(), customers=(), items=()):
    return gold.gold_order_summary(
        silver.silver_orders(seed(spark, "orders", orders)),
        silver.silver_customers(seed(spark, "customers", customers)),
        silver.silver_order_items(seed(spark, "order_items", items)),
    )


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_seed_gives_known_mart(spark):
    got = {
        r.order_id: (r.customer_id, r.customer_name, r.status, r.item_count, r.total_amount_cents)
        for r in mart(spark).collect()
    }
    assert got == {
        1: (1, "Ada Lovelace", "placed", 2, 15997),
        2: (2, "Grace Hopper", "shipped", 1, 45999),
        3: (3, "Linus Torvalds", "placed", 1, 4995),
    }


def test_times_keep_milliseconds(spark):
    row = silver.silver_orders(seed(spark, "orders")).first()
    assert row.placed_at == datetime.datetime(2026, 8, 12, 12, 0, 0, 123000)


def order(status, updated=NOON, key=2):
    return (key, 2, status, NOON, updated)


def test_update_wins_and_late_event_does_not(spark):
    events = [
        event("orders", "u", order("shipped"), order("delivered"), T0 + 10, 50),
        event("orders", "u", order("placed"), order("cancelled"), T0 - 10, 60),
    ]
    for given in (events, events[::-1]):
        assert by_key(mart(spark, given), "order_id")[2].status == "delivered"


def test_equal_time_falls_back_to_log_position(spark):
    events = [
        event("orders", "u", order("shipped"), order("delivered"), T0 + 10, 50),
        event("orders", "u", order("delivered"), order("cancelled"), T0 + 10, 51),
    ]
    assert by_key(mart(spark, events), "order_id")[2].status == "cancelled"


def test_delete_drops_row_and_reinsert_brings_it_back(spark):
    gone = [event("orders", "d", order("shipped"), None, T0 + 10, 50)]
    assert set(by_key(mart(spark, gone), "order_id")) == {1, 3}
    back = [*gone, event("orders", "c", None, order("placed"), T0 + 20, 51)]
    assert by_key(mart(spark, back), "order_id")[2].status == "placed"


def test_deleted_customer_leaves_order(spark):
    gone = [event("customers", "d", (2, "grace@example.com", "Grace Hopper", "US", NOON), None, T0 + 1, 9)]
    row = by_key(mart(spark, customers=gone), "order_id")[2]
    assert (row.customer_id, row.customer_name, row.customer_email) == (2, None, None)


def test_order_without_items_counts_zero(spark):
    row = by_key(mart(spark, [event("orders", "c", None, (9, 4, "placed", NOON, NOON), T0, 70)]), "order_id")[9]
    assert (row.item_count, row.total_amount_cents) == (0, 0)


def test_null_op_is_dropped_and_null_key_kept(spark):
    events = [
        event("orders", None, None, order("delivered"), T0 + 10, 50),
        event("orders", "c", None, (None, 1, "placed", NOON, NOON), T0, 71),
    ]
    got = by_key(silver.silver_orders(seed(spark, "orders", events)), "order_id")
    assert set(got) == {1, 3, None}


def test_null_time_loses(spark):
    events = [event("orders", "u", order("shipped"), order("cancelled"), None, 99)]
    for form in (silver.silver, silver.silver_by_max):
        assert by_key(form(seed(spark, "orders", events), ORDERS), "order_id")[2].status == "shipped"


def test_bad_time_is_null(spark):
    events = [event("orders", "u", None, order("shipped", updated="yesterday"), T0 + 10, 50)]
    assert by_key(silver.silver_orders(seed(spark, "orders", events)), "order_id")[2].updated_at is None


@pytest.mark.parametrize("name", sorted(TABLES))
def test_state_ignores_order_copies_and_form(spark, sf_dir, name):
    events = bronze(spark, sf_dir, name)
    want = silver.silver(events, TABLES[name])
    messy = events.unionByName(events.where("source.lsn % 2 = 0")).repartition(5, F.rand(7))
    same_rows(silver.silver(messy, TABLES[name]), want)
    same_rows(silver.silver_by_max(messy, TABLES[name]), want)


def joined_then_grouped(orders, customers, items):
    """The mart as a join of rows followed by one wide grouping."""
    c = customers.select("customer_id", F.col("full_name").alias("customer_name"), F.col("email").alias("customer_email"))
    line = F.col("quantity").cast("bigint") * F.col("unit_price_cents")
    return (
        orders.join(c, "customer_id", "left")
        .join(items, "order_id", "left")
        .groupBy("order_id", "customer_id", "customer_name", "customer_email", "status", "placed_at")
        .agg(
            F.count("order_item_id").alias("item_count"),
            F.coalesce(F.sum(line), F.lit(0)).alias("total_amount_cents"),
        )
    )


def test_both_mart_forms_agree(spark, sf_dir):
    o, c, i = (silver.silver(bronze(spark, sf_dir, n), TABLES[n]) for n in ("orders", "customers", "order_items"))
    same_rows(gold.gold_order_summary(o, c, i), joined_then_grouped(o, c, i))


def skewed(spark):
    """A third of the orders belong to customer 7, some to nobody, some to a customer that is gone."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN -1 ELSE id % 100 END"
    facts = spark.range(30_000).selectExpr("id AS order_id", f"CAST({key} AS BIGINT) AS customer_id")
    dim = spark.range(100).selectExpr("id AS customer_id", "concat('name ', id) AS name")
    return facts, dim


@pytest.mark.parametrize("share", [1 / 30_000, 1 / 200, 1.0])
def test_salted_join_equals_plain_join(spark, share):
    facts, dim = skewed(spark)
    hot = hot_keys(facts, "customer_id", share)
    got = salted_left_join(facts, dim, "customer_id", "order_id", hot)
    same_rows(got, facts.join(dim, "customer_id", "left"))


def test_hot_key_is_spread_over_many_tasks(spark):
    facts, dim = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = hot_keys(facts, "customer_id", 1 / 50)
        assert {r.customer_id: r.salts for r in hot.collect()} == {7: 17, -1: 3}
        joined = salted_left_join(facts, dim, "customer_id", "order_id", hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().select("count").toPandas()["count"]
        assert len(sizes) == 8 and sizes.max() < 2 * sizes.sum() / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_snapshot_diff_leads_from_old_to_new(spark, sf_dir):
    rows = base_rows(spark, sf_dir, "orders").drop("base_ms")
    old = rows.where("order_id % 7 <> 0")
    new = rows.where("order_id % 11 <> 0").withColumn(
        "status", F.when(F.col("order_id") % 3 == 0, F.lit(None)).otherwise(F.col("status"))
    )
    changes = snapshot_diff(old, new, "order_id")
    assert {r.op for r in changes.select("op").distinct().collect()} == {"c", "u", "d"}
    same_rows(apply_changes(old, changes, "order_id"), new)
    assert snapshot_diff(new, new, "order_id").isEmpty()


def test_snapshot_diff_sees_columns_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "id bigint, x string")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 1), (3, "c", 2)], "id bigint, x string, y int")
    changes = {r.k: (r.op, r.before, r.after) for r in snapshot_diff(old, new, "id").collect()}
    assert {k: v[0] for k, v in changes.items()} == {1: "u", 3: "?", None: "d"}
    assert changes[1][1:] == ((1, "a", None), (1, "a", 1))
    back = {r.k: r.op for r in snapshot_diff(new.where("id < 3"), old, "id").collect()}
    assert back == {1: "u", 3: "c", None: "c"}
    plan = snapshot_diff(old, new, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_no_number_changes_when_types_unify(spark):
    from changeflow.operators.evolve import wider
    from pyspark.sql import types as T

    assert wider(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    for other in (T.FloatType(), T.DoubleType(), T.StringType()):
        with pytest.raises(ValueError, match="no common type"):
            wider(T.LongType(), other)


def test_empty_log(spark):
    assert silver.silver_order_items(log(spark, "order_items", [])).isEmpty()
    assert silver.silver_by_max(log(spark, "order_items", []), ORDER_ITEMS).isEmpty()
