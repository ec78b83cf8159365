"""Streams drained to the end: raw append, resume, replay, restart after an outage, current state."""

import pytest
from pyspark.sql import functions as F

from changeflow.operators.evolve import union_versions
from changeflow.operators.reconcile import reconcile_markers
from changeflow.operators.runs import latency_percentiles
from changeflow.plans import silver
from changeflow.plans.shop import CUSTOMERS, ORDERS, ShopTable
from changeflow.sources.decode import encode_envelopes
from changeflow.sources.envelope import envelope_schema
from changeflow.sources.topics import MESSAGE, POSITIONED, subscribe_files, topic_name
from changeflow.streaming import state
from changeflow.streaming.bronze import land, land_or_quarantine
from changeflow.workload import streams
from changeflow.workload.derive import bronze
from shopdata import NOON, T0, event, log, seed
from test_state import same_rows


@pytest.fixture
def namespace(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS bronze")
    yield
    spark.sql("DROP SCHEMA IF EXISTS bronze CASCADE")


def send(events, key, topic):
    encode_envelopes(events, key).coalesce(1).write.mode("append").parquet(topic)


def drain(spark, table, topic, target, checkpoint, schema=MESSAGE):
    query = land(subscribe_files(spark, topic, 1, schema), table, target, checkpoint, available_now=True)
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def test_topic_name():
    assert topic_name("orders") == "shop.shop.orders"


def test_append_resume_and_replay(spark, namespace, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    send(seed(spark, "orders"), "order_id", topic)
    assert not spark.catalog.tableExists("bronze.orders")
    assert drain(spark, ORDERS, topic, "bronze.orders", checkpoint) == 3
    assert spark.table("bronze.orders").count() == 3
    assert drain(spark, ORDERS, topic, "bronze.orders", checkpoint) == 0

    change = log(spark, "orders", [event("orders", "u", None, (2, 2, "delivered", NOON, NOON), T0 + 5, 90)])
    send(change, "order_id", topic)
    assert drain(spark, ORDERS, topic, "bronze.orders", checkpoint) == 1
    before = silver.silver_orders(spark.table("bronze.orders")).collect()

    # position lost: everything comes again, current state stays the same
    assert drain(spark, ORDERS, topic, "bronze.replayed", str(tmp_path / "other")) == 4
    again = spark.table("bronze.orders").unionByName(spark.table("bronze.replayed"))
    assert sorted(silver.silver_orders(again).collect()) == sorted(before)


def test_poison_stops_the_stream(spark, namespace, tmp_path):
    topic = str(tmp_path / "topic")
    send(seed(spark, "orders"), "order_id", topic)
    spark.createDataFrame([("9", '{"op":')], "key string, value string").write.mode("append").parquet(topic)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        drain(spark, ORDERS, topic, "bronze.orders", str(tmp_path / "checkpoint"))


def test_outage_loses_no_marker(spark, namespace, tmp_path):
    """The stream dies on a batch and is started again on the same checkpoint."""
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    markers = [(10 + i, f"chaos-test-{i}@example.com", f"Chaos Test {i}", "ZZ", NOON) for i in range(3)]
    send(seed(spark, "customers"), "customer_id", topic)
    drain(spark, CUSTOMERS, topic, "bronze.customers", checkpoint)
    for row in markers:
        send(log(spark, "customers", [event("customers", "c", None, row)]), "customer_id", topic)

    held = tmp_path / "topic" / "held.parquet"
    good = encode_envelopes(seed(spark, "customers").limit(1), "customer_id").toPandas()
    good.assign(value="{").to_parquet(str(held))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        drain(spark, CUSTOMERS, topic, "bronze.customers", checkpoint)

    # the record is repaired and the stream goes on where it stopped
    good.to_parquet(str(held))
    drain(spark, CUSTOMERS, topic, "bronze.customers", checkpoint)
    expected = spark.createDataFrame([(m[1], 1) for m in markers], "marker string, expected bigint")
    got = reconcile_markers(expected, spark.table("bronze.customers"), "email", "chaos-test-")
    assert {r.verdict for r in got.collect()} <= {"ok", "duplicated"} and got.count() == 3


def write_in_parts(events, path, parts):
    for i in range(parts):
        share = events.where(F.pmod(F.xxhash64("source.lsn", "ts_ms"), F.lit(parts)) == i)
        share.coalesce(1).write.mode("append").parquet(path)


def follow(spark, events, path, target, checkpoint):
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = state.maintain(stream, ORDERS, target, checkpoint, available_now=True)
    query.awaitTermination()
    return len([p for p in query.recentProgress if p.numInputRows])


def batches(spark, target):
    return {(r.stream, r.batch): r.n for r in spark.table(target).groupBy("stream", "batch").agg(F.count("*").alias("n")).collect()}


def test_stream_equals_batch(spark, namespace, tmp_path):
    """Events in arbitrary batches, so that many come late, give what a full rebuild gives."""
    events = bronze(spark, "/root/testdata/sf0.001", "orders")
    src, target, checkpoint = str(tmp_path / "src"), "bronze.state", str(tmp_path / "c")
    write_in_parts(events, src, 3)
    assert follow(spark, events, src, target, checkpoint) == 3
    same_rows(state.read_current(spark, ORDERS, target), silver.silver_orders(events))
    assert follow(spark, events, src, target, checkpoint) == 0

    # everything again from a fresh position
    follow(spark, events, src, target, str(tmp_path / "c2"))
    same_rows(state.read_current(spark, ORDERS, target), silver.silver_orders(events))


def test_state_lies_in_rocksdb_and_leaves_the_session_alone(spark, namespace, tmp_path):
    events = seed(spark, "orders")
    src = str(tmp_path / "src")
    events.coalesce(1).write.parquet(src)
    follow(spark, events, src, "bronze.state", str(tmp_path / "c"))
    held = [f.suffix for f in (tmp_path / "c" / "state").rglob("*") if f.is_file()]
    assert ".changelog" in held or ".zip" in held
    assert all(spark.conf.get(k, None) != v for k, v in state.STATE_STORE.items() if "provider" in k)


def in_steps(spark, tmp_path, *steps):
    """Each step's events as a file of their own; the stream is stopped and started again before every one."""
    src = str(tmp_path / "src")
    for events in steps:
        events.coalesce(1).write.mode("append").parquet(src)
        assert follow(spark, events, src, "bronze.state", str(tmp_path / "c")) == 1


def test_late_event_does_not_revive_a_deleted_key(spark, namespace, tmp_path):
    row = (2, 2, "shipped", NOON, NOON)
    in_steps(
        spark,
        tmp_path,
        seed(spark, "orders"),
        log(spark, "orders", [event("orders", "d", row, None, T0 + 50, 50)]),
        log(spark, "orders", [event("orders", "u", row, row, T0 + 10, 40)]),
    )
    assert {r.order_id for r in state.read_current(spark, ORDERS, "bronze.state").collect()} == {1, 3}
    assert {r.order_id: r.op for r in state.read_all(spark, ORDERS, "bronze.state").collect()} == {1: "r", 2: "d", 3: "r"}


DELIVERED = event("orders", "u", None, (2, 2, "delivered", NOON, NOON), T0 + 5, 90)


def newest(spark, *events):
    return state.newest_events(log(spark, "orders", list(events)), ORDERS)


def test_batch_run_again_replaces_its_first_attempt(spark, namespace):
    write = state.write_batch(spark, ORDERS, "bronze.state", "s")
    write(state.newest_events(seed(spark, "orders"), ORDERS), 0)
    for _ in range(2):
        write(newest(spark, DELIVERED), 1)
    got = {r.order_id: r.status for r in state.read_current(spark, ORDERS, "bronze.state").collect()}
    assert got == {1: "placed", 2: "delivered", 3: "placed"}
    assert batches(spark, "bronze.state") == {("s", 0): 3, ("s", 1): 1}
    # the first batch of another stream is another batch
    state.write_batch(spark, ORDERS, "bronze.state", "other")(newest(spark, DELIVERED), 0)
    assert batches(spark, "bronze.state") == {("s", 0): 3, ("s", 1): 1, ("other", 0): 1}
    assert state.read_current(spark, ORDERS, "bronze.state").count() == 3


def test_compact_keeps_the_newest_of_all_keys(spark, namespace):
    write = state.write_batch(spark, ORDERS, "bronze.state", "s")
    write(state.newest_events(seed(spark, "orders"), ORDERS), 0)
    write(newest(spark, DELIVERED, event("orders", "d", (3, 3, "placed", NOON, NOON), None, T0 + 9, 91)), 1)
    before = {tuple(r) for r in state.read_all(spark, ORDERS, "bronze.state").collect()}
    for settled in (1, 2):
        state.compact(spark, ORDERS, "bronze.state")
        assert batches(spark, "bronze.state") == {(state.SETTLED, settled): 3}
        assert {tuple(r) for r in state.read_all(spark, ORDERS, "bronze.state").collect()} == before
    # a batch from before that comes again changes nothing
    write(state.newest_events(seed(spark, "orders"), ORDERS), 0)
    assert {tuple(r) for r in state.read_all(spark, ORDERS, "bronze.state").collect()} == before


def test_a_batch_costs_what_it_holds(spark, namespace, tmp_path):
    """A batch writes the keys that it touched, whatever the state holds."""
    many = bronze(spark, "/root/testdata/sf0.001", "orders")
    in_steps(spark, tmp_path, many, log(spark, "orders", [DELIVERED]))
    sizes = {b: n for (_, b), n in batches(spark, "bronze.state").items()}
    assert sizes == {0: 1500, 1: 1}


def test_events_without_key_time_or_code(spark, namespace, tmp_path):
    odd = [
        event("orders", None, None, (1, 1, "x", NOON, NOON), T0 + 10, 50),
        event("orders", "u", None, (2, 2, "lost", NOON, NOON), None, 99),
        event("orders", "c", None, (None, 1, "placed", NOON, NOON), T0, 71),
    ]
    events = seed(spark, "orders", odd)
    in_steps(spark, tmp_path, seed(spark, "orders"), log(spark, "orders", odd))
    same_rows(state.read_current(spark, ORDERS, "bronze.state"), silver.silver_orders(events))


def test_no_state_yet(spark):
    assert state.read_current(spark, ORDERS, "default.none_yet").isEmpty()


def test_row_image_grows_and_widens(spark, tmp_path):
    """A column joins the row image and a number widens; old files are read with the new schema."""
    topic, path, checkpoint = (str(tmp_path / n) for n in ("topic", "raw", "checkpoint"))
    v1 = ShopTable("products", "product_id", "product_id bigint, price_cents int", ("price_cents",))
    v2 = ShopTable(
        "products", "product_id", "product_id bigint, price_cents bigint, sku string", ("price_cents", "sku")
    )
    old = spark.createDataFrame([event("products", "c", None, (k, 10)) for k in (1, 2)], envelope_schema(v1.image))
    new = spark.createDataFrame(
        [event("products", "u", (2, 10, None), (2, 2**40, "x"), T0 + 1, 9)], envelope_schema(v2.image)
    )
    send(old, "product_id", topic)
    drain(spark, v1, topic, path, checkpoint)
    send(new, "product_id", topic)
    drain(spark, v2, topic, path, checkpoint)
    raw = spark.read.schema(envelope_schema(v2.image)).parquet(path)
    assert sorted(map(tuple, silver.silver(raw, v2).collect())) == [(1, 10, None), (2, 2**40, "x")]
    union = union_versions(old, new)
    assert union.schema["after"].dataType == new.schema["after"].dataType
    assert sorted(map(tuple, silver.silver(union, v2).collect())) == [(1, 10, None), (2, 2**40, "x")]


def test_landed_table_follows_the_row_image(spark, namespace, tmp_path):
    """Old, new and old images again into one table and on one checkpoint: no field is lost, nothing comes twice."""
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    v1 = ShopTable("products", "product_id", "product_id bigint, price_cents int", ("price_cents",))
    v2 = ShopTable("products", "product_id", "product_id bigint, price_cents bigint, sku string", ("price_cents", "sku"))

    def change(table, row, step):
        return spark.createDataFrame([event("products", "c", None, row, T0 + step, step)], envelope_schema(table.image))

    for table, row, step in ((v1, (1, 10), 1), (v2, (2, 2**40, "x"), 2), (v1, (3, 30), 3)):
        send(change(table, row, step), "product_id", topic)
        assert drain(spark, table, topic, "bronze.products", checkpoint) == 1
    raw = spark.table("bronze.products")
    assert sorted(map(tuple, silver.silver(raw, v2).collect())) == [(1, 10, None), (2, 2**40, "x"), (3, 30, None)]
    assert {r.message_key for r in raw.collect()} == {"1", "2", "3"}
    # a field that the reader's image lacks is kept by name
    send(change(v2, (4, 40, "y"), 4), "product_id", topic)
    drain(spark, v1, topic, "bronze.products", checkpoint)
    rest = {r.after.product_id: r.rest for r in spark.table("bronze.products").collect()}
    assert rest == {1: None, 2: None, 3: None, 4: {"sku": "y"}}


def test_positions_are_landed(spark, namespace, tmp_path):
    topic = str(tmp_path / "topic")
    messages = encode_envelopes(seed(spark, "orders"), "order_id").coalesce(1)
    messages.selectExpr("*", "'t' AS topic", "0 AS partition", "monotonically_increasing_id() AS offset").write.parquet(topic)
    drain(spark, ORDERS, topic, "bronze.orders", str(tmp_path / "checkpoint"), POSITIONED)
    got = spark.table("bronze.orders").select("topic", "partition", "offset").collect()
    assert sorted(map(tuple, got)) == [("t", 0, 0), ("t", 0, 1), ("t", 0, 2)]


def test_latency_of_landed_events(spark, namespace, tmp_path):
    topic = str(tmp_path / "topic")
    send(seed(spark, "orders"), "order_id", topic)
    drain(spark, ORDERS, topic, "bronze.orders", str(tmp_path / "checkpoint"))
    landed = spark.table("bronze.orders").selectExpr("ingest_ms", "source.ts_ms AS source_ms")
    measured = latency_percentiles(landed).first()
    waits = [r.ingest_ms - r.source_ms for r in landed.collect()]
    assert min(waits) <= measured.p50 <= measured.p95 <= max(waits)


def test_quarantine_lands_the_rest(spark, namespace, tmp_path):
    topic = str(tmp_path / "topic")
    deleted = event("orders", "d", (1, 1, "placed", NOON, NOON), None, T0 + 1, 9)
    send(seed(spark, "orders", [deleted]), "order_id", topic)
    bad = ['{"op":', "", '{"after":{"order_id":"7","customer_id":1,"status":"x"},"op":"c"}', '{"op":"c"}']
    whole = '{"order_id":7,"customer_id":1,"status":"x","placed_at":null,"updated_at":null}'
    bad.append(f'{{"after":{whole},"op":"c","ts_ms":"soon"}}')
    spark.createDataFrame([("9", b) for b in bad] + [("9", None)], "key string, value string").write.mode(
        "append"
    ).parquet(topic)
    land_or_quarantine(
        subscribe_files(spark, topic), ORDERS, "bronze.orders", "bronze.orders_held", str(tmp_path / "c"), True
    ).awaitTermination()
    assert spark.table("bronze.orders").count() == 4
    assert {r.order_id for r in silver.silver_orders(spark.table("bronze.orders")).collect()} == {2, 3}
    held = {r.value: r.field for r in spark.table("bronze.orders_held").collect()}
    assert held == {bad[0]: "*", bad[1]: "*", bad[2]: "order_id", bad[3]: "*", bad[4]: "*"}


def test_events_are_dealt_into_files_of_bounded_size(spark, monkeypatch, tmp_path):
    """However long the log, a task that deals it out gets about as many events as a file may hold."""
    rows = spark.range(6000).selectExpr(
        "id % 2500 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "cast(id AS double) AS l_quantity",
        "cast(id AS double) AS l_extendedprice", "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "date_add(date'2024-01-01', cast(id % 900 AS int)) AS l_shipdate",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(streams, "FILE_EVENTS", 200, raising=False)
    monkeypatch.setattr(streams, "shared_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(streams, "remove_dir", lambda spark, path: None)
    got = streams.stream_current_state(spark, str(tmp_path))
    same_rows(got, silver.silver_order_items(bronze(spark, str(tmp_path), "order_items")))
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/state/events").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 400
    assert len(spark.read.text(f"{tmp_path}/state/checkpoint/commits").select(F.input_file_name()).distinct().collect()) == streams.BATCHES
