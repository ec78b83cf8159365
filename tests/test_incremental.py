"""The incremental mart against a full build after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.plans import gold, silver
from changeflow.plans.incremental import IncrementalMart, apply_batch, read_mart
from changeflow.workload.derive import bronze
from shopdata import NOON, T0, event, log, rows_of, seed
from test_state import same_rows


@pytest.fixture
def mart(spark):
    yield IncrementalMart("steps")
    spark.sql("DROP SCHEMA IF EXISTS steps CASCADE")


def full(logs):
    return gold.gold_order_summary(
        silver.silver_orders(logs["orders"]), silver.silver_customers(logs["customers"]), silver.silver_order_items(logs["order_items"])
    )


def sizes(spark, mart, part):
    return {r.batch: r["count"] for r in spark.table(mart.name(part)).groupBy("batch").count().collect()}


def random_events(seed_, n, batch):
    """Updates, deletes, late events, copies, items that change their order, customers that come and go, null keys."""
    random.seed(seed_ * 100 + batch)
    made = {"orders": [], "customers": [], "order_items": []}
    for _ in range(n):
        t, lsn = T0 + random.randint(-30, 40), random.randint(1, 10**6)
        name = random.choice(["orders", "order_items", "order_items", "customers"])
        key = random.choice([None, *range(1, 9)])
        row = {
            "orders": (key, random.choice([1, 1, 1, 2, 3, 9, None]), random.choice(["placed", "shipped", None]), NOON, NOON),
            "customers": (key, f"{random.choice('abc')}@example.com", random.choice(["Ann", "Bo", None]), "GB", NOON),
            "order_items": (key, random.choice([1, 1, 2, 3, 4, None]), 1, random.choice([1, 2, None]), random.randint(1, 900)),
        }[name]
        op = random.choice(["c", "u", "u", "d", None])
        made[name] += [event(name, op, row, None if op == "d" else row, t, lsn)] * random.choice([1, 1, 2])
    return made


@pytest.mark.parametrize("seed_", [1, 2])
def test_equals_full_build_after_every_batch(spark, mart, seed_):
    logs = {n: [event(n, "r", None, r, lsn=i) for i, r in enumerate(rows_of(n))] for n in ("orders", "customers", "order_items")}
    for batch in range(6):
        given = logs if batch == 0 else random_events(seed_, 14, batch)
        if batch:
            logs = {n: logs[n] + given[n] for n in logs}
        frames = {n: log(spark, n, e) for n, e in given.items() if e or batch != 3}
        for _ in range(1 + (batch == 4)):  # one batch is run again
            apply_batch(spark, mart, batch, frames)
        same_rows(read_mart(spark, mart), full({n: log(spark, n, e) for n, e in logs.items()}))


def test_rows_written_follow_the_batch(spark, mart):
    apply_batch(spark, mart, 0, {n: bronze(spark, "/root/testdata/sf0.001", n) for n in ("orders", "customers", "order_items")})
    known = read_mart(spark, mart).where("item_count > 0").orderBy("order_id").first()
    new = event("order_items", "c", None, (999_999_999, known.order_id, 1, 2, 50), T0, 1)
    apply_batch(spark, mart, 1, {"order_items": log(spark, "order_items", [new])})
    assert [sizes(spark, mart, p).get(1, 0) for p in ("order_items", "totals", "mart", "orders", "customers")] == [1, 1, 1, 0, 0]
    row = read_mart(spark, mart).where(F.col("order_id") == known.order_id).first()
    assert (row.item_count, row.total_amount_cents) == (known.item_count + 1, known.total_amount_cents + 100)
    # a copy and a late event change nothing, so nothing is written
    late = event("order_items", "u", None, (999_999_999, known.order_id, 1, 7, 50), T0 - 1, 1)
    apply_batch(spark, mart, 2, {"order_items": log(spark, "order_items", [new, late])})
    assert all(2 not in sizes(spark, mart, p) for p in ("order_items", "totals", "mart"))
    # a customer's new country is not shown in the mart, a new name is, in all their orders
    person = spark.table(mart.name("customers")).where(F.col("customer_id") == known.customer_id).first()
    for batch, name in ((3, person.full_name), (4, "Other Name")):
        image = (known.customer_id, person.email, name, "ZZ", person.signup_at)
        apply_batch(spark, mart, batch, {"customers": log(spark, "customers", [event("customers", "u", None, image, T0 * 2 + batch, 1)])})
    orders = read_mart(spark, mart).where(F.col("customer_id") == known.customer_id)
    assert 3 not in sizes(spark, mart, "mart") and sizes(spark, mart, "mart")[4] >= orders.count()
    assert {r.customer_name for r in orders.collect()} == {"Other Name"}


def test_one_customer_with_most_orders(spark, mart):
    """A third of all orders hang on one customer, who is renamed."""
    orders = spark.range(3000).selectExpr("id AS order_id", "IF(id % 3 = 0, 7, id % 50) AS customer_id")
    rows = [tuple(r) for r in orders.collect()]
    logs = {
        "orders": log(spark, "orders", [event("orders", "c", None, (*r, "placed", NOON, NOON)) for r in rows]),
        "customers": log(spark, "customers", [event("customers", "c", None, (k, "x@example.com", f"n{k}", "GB", NOON)) for k in range(50)]),
        "order_items": log(spark, "order_items", [event("order_items", "c", None, (i, 1, 1, 1, 1)) for i in range(500)]),
    }
    apply_batch(spark, mart, 0, logs)
    renamed = log(spark, "customers", [event("customers", "u", None, (7, "x@example.com", "new", "GB", NOON), T0 + 1)])
    apply_batch(spark, mart, 1, {"customers": renamed})
    logs["customers"] = logs["customers"].unionByName(renamed)
    same_rows(read_mart(spark, mart), full(logs))
    assert sizes(spark, mart, "mart")[1] == sum(r[1] == 7 for r in rows)


def test_empty_tables(spark, mart):
    empty = {n: log(spark, n, []) for n in ("orders", "customers", "order_items")}
    apply_batch(spark, mart, 0, empty)
    assert read_mart(spark, mart).isEmpty()
    apply_batch(spark, mart, 1, {n: seed(spark, n) for n in empty})
    same_rows(read_mart(spark, mart), full({n: seed(spark, n) for n in empty}))
