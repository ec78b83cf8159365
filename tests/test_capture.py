"""A snapshot read in chunks beside a running log."""

import pytest
from pyspark.sql import functions as F

from changeflow.plans import silver
from changeflow.plans.shop import ORDERS
from changeflow.sources.capture import chunk_of, merge_snapshot, snapshot_diff, snapshot_diff_by_range
from changeflow.workload.derive import bronze
from changeflow.workload.state import CHUNK, chunked_snapshot
from shopdata import NOON, T0, event, log
from test_state import same_rows

WINDOWS = "chunk bigint, low struct<ts_ms: bigint, lsn: bigint>, high struct<ts_ms: bigint, lsn: bigint>"
ROW = "order_id bigint, customer_id bigint, status string, placed_at string, updated_at string"


def row(key, status):
    return (key, 1, status, NOON, NOON)


def merged(spark, rows, windows, events, size=10):
    frames = spark.createDataFrame(rows, ROW), spark.createDataFrame(windows, WINDOWS), log(spark, "orders", events)
    return merge_snapshot(*frames, "order_id", size, "orders")


def statuses(envelopes):
    return {r.order_id: r.status for r in silver.silver_orders(envelopes).collect()}


def test_no_stale_row_wins(spark):
    window = [(0, (T0 + 100, 0), (T0 + 200, 0)), (1, (T0 + 300, 0), (T0 + 400, 0))]
    events = [
        event("orders", "u", None, row(1, "before the window"), T0 + 50, 1),
        event("orders", "u", None, row(2, "in the window"), T0 + 150, 2),
        event("orders", "d", row(3, "x"), None, T0 + 160, 3),
        event("orders", "u", None, row(4, "after the window"), T0 + 250, 4),
        event("orders", "u", None, row(12, "in the other window"), T0 + 150, 5),
        event("orders", "c", None, row(5, "new in the window"), T0 + 170, 6),
        event("orders", "u", None, row(6, "at its end"), T0 + 200, 0),
        event("orders", "u", None, row(7, "at its beginning"), T0 + 100, 0),
    ]
    rows = [row(k, s) for k, s in ((1, "read"), (2, "stale"), (3, "stale"), (4, "read"), (6, "stale"), (7, "read"), (8, "read"), (12, "read"), (None, "read"))]
    window.append((-(2**62), (T0, 0), (T0 + 9, 0)))
    got = merged(spark, rows, window, events)
    assert statuses(got) == {
        1: "read", 2: "in the window", 4: "after the window", 5: "new in the window", 6: "at its end", 7: "read", 8: "read",
        12: "read", None: "read",
    }
    reads = got.where("op = 'r'").select("after.order_id", "ts_ms").collect()
    assert {r.order_id for r in reads} == {1, 4, 7, 8, 12, None}
    assert {r.ts_ms for r in reads if r.order_id == 12} == {T0 + 400}


def test_chunks_are_independent(spark):
    rows, windows, events = chunked_snapshot(bronze(spark, "/root/testdata/sf0.001", "orders"))
    whole = merge_snapshot(rows, windows, events, "order_id", CHUNK, "orders").where("op = 'r' AND source.lsn = 0 AND after.order_id > 0")
    parts = None
    for c in [r.chunk for r in windows.collect()]:
        mine = F.col("chunk") == c
        part = merge_snapshot(rows.where(chunk_of(F.col("order_id"), CHUNK) == c), windows.where(mine), events, "order_id", CHUNK, "orders")
        part = part.where("op = 'r' AND source.lsn = 0 AND after.order_id > 0")
        parts = part if parts is None else parts.unionByName(part)
    flat = lambda df: df.select("after.*", "ts_ms")
    same_rows(flat(whole), flat(parts))
    assert 0 < whole.count() < rows.count()


def test_rows_in_the_window_matter(spark):
    """Without the windows' rule some read rows would stand that the log has moved on from."""
    events = bronze(spark, "/root/testdata/sf0.001", "orders")
    rows, windows, kept = chunked_snapshot(events)
    want = silver.silver_orders(events)
    same_rows(silver.silver_orders(merge_snapshot(rows, windows, kept, "order_id", CHUNK, "orders")), want)
    none = log(spark, "orders", [])
    careless = merge_snapshot(rows, windows, none, "order_id", CHUNK, "orders").unionByName(kept.select("before", "after", "op", "ts_ms", "source"))
    assert not silver.silver_orders(careless).exceptAll(want).isEmpty()


@pytest.mark.parametrize("empty", ["rows", "log", "all"])
def test_empty_sides(spark, empty):
    window = [(0, (T0, 0), (T0 + 9, 0))]
    rows = [] if empty in ("rows", "all") else [row(1, "read")]
    events = [] if empty in ("log", "all") else [event("orders", "c", None, row(2, "sent"), T0 + 5, 1)]
    want = ({} if empty in ("rows", "all") else {1: "read"}) | ({} if empty in ("log", "all") else {2: "sent"})
    assert statuses(merged(spark, rows, window if empty != "all" else [], events)) == want


def test_one_chunk_with_most_events(spark):
    """A key range that holds nearly all events."""
    sent = [event("orders", "u", None, row(k % 9, f"s{i}"), T0 + i, i) for i, k in enumerate(range(900))]
    got = statuses(merged(spark, [row(k, "read") for k in range(12)], [(0, (T0 - 5, 0), (T0 + 2000, 0)), (1, (T0, 0), (T0, 0))], sent))
    assert got == {**{k: f"s{891 + k}" for k in range(9)}, 9: "read", 10: "read", 11: "read"}


def test_orders_schema():
    assert ORDERS.image == ROW


def snapshots(spark):
    old = spark.createDataFrame([(i, f"s{i % 5}", i) for i in range(3000)] + [(None, "n", 0), (77, "s2", 77), (900, "s0", 900)], "id bigint, s string, n int")
    new = spark.createDataFrame(
        [(i, "new" if i % 1000 == 7 else f"s{i % 5}", i) for i in range(3000) if i not in (5, 2999)] + [(None, "m", 0), (77, "s2", 77), (4000, None, None)],
        "id bigint, s string, n int",
    )
    return old, new


@pytest.mark.parametrize("ranges", [2, 16, 1024])
def test_diff_by_range_equals_the_whole_diff(spark, ranges):
    old, new = snapshots(spark)
    want = {str(r.k): (r.op, r.before, r.after) for r in snapshot_diff(old, new, "id").collect()}
    got = {str(r.k): (r.op, r.before, r.after) for r in snapshot_diff_by_range(old, new, "id", ranges).collect()}
    # a key that comes twice and alike on both sides is no change
    assert want.pop("77")[0] == "?"
    assert got == want and {v[0] for v in got.values()} == {"c", "u", "d", "?"}


def test_diff_by_range_of_other_columns_and_empty_sides(spark):
    old, new = snapshots(spark)
    wide = new.withColumn("row", F.when(F.col("id") == 9, 1)).withColumn("k", F.lit(None).cast("string")).withColumn("small", F.lit(None).cast("int"))
    got = {r.k for r in snapshot_diff_by_range(new, wide, "id", 16).collect()}
    assert got == {9}
    none = old.where("false")
    assert snapshot_diff_by_range(none, none, "id").isEmpty()
    assert snapshot_diff_by_range(none, new, "id", 16).count() == new.select("id").distinct().count()
    swapped = spark.createDataFrame([(1, None, 5), (2, "5", None)], "id bigint, s string, n int")
    assert snapshot_diff_by_range(swapped, swapped.withColumn("n", F.lit(None).cast("int")), "id").count() == 1


def test_rows_of_like_ranges_are_not_shuffled(spark):
    """The rows that meet in the join at the end are those of the few ranges that differ."""
    rows = spark.range(200_000).selectExpr("id", "concat('x', id) AS s")
    new = rows.withColumn("s", F.when(F.col("id") == 123_456, "y").otherwise(F.col("s")))
    found = snapshot_diff_by_range(rows, new, "id", 64)
    assert [(r.k, r.op) for r in found.collect()] == [(123_456, "u")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    chosen = found._jdf.queryExecution().optimizedPlan().toString()
    assert chosen.count("LeftSemi") >= 4
