"""Queries over the raw change logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.iso8601 import parse_iso8601
from changeflow.operators.evolve import union_versions
from changeflow.operators.reconcile import arrival_check as check_arrival
from changeflow.operators.reconcile import reconcile_markers
from changeflow.plans.shop import ORDERS, TABLES
from changeflow.sources import routing
from changeflow.sources.capture import snapshot_diff as diff
from changeflow.sources.capture import snapshot_diff_by_range as diff_by_range
from changeflow.sources.capture import snapshot_envelopes as snapshot_events
from changeflow.sources.decode import decode_envelopes as decode
from changeflow.sources.decode import drop_tombstones as without_tombstones
from changeflow.sources.decode import encode_envelopes
from changeflow.sources.envelope import event_key, op_counts, preview
from changeflow.sources.envelope import key_recovery as recover_keys
from changeflow.workload import sql
from changeflow.workload.derive import base_rows, bronze, order_item_events, table
from changeflow.workload.registry import query


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query(
    "SELECT \"table\", op, count(*) AS n FROM ("
    + sql.union_all([f"SELECT '{n}' AS \"table\", op FROM ({sql.events(n)})" for n in TABLES])
    + ") GROUP BY ALL"
)
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [bronze(spark, sf_dir, n).select(F.col("source.table").alias("table"), "op") for n in TABLES]
    return op_counts(_union(logs), by=("table",))


@query(f"SELECT 'orders' AS \"table\", op, count(*) AS n FROM ({sql.events('orders')}) GROUP BY ALL")
def op_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = bronze(spark, sf_dir, "orders").select(F.col("source.table").alias("table"), "op")
    return op_counts(log, by=("table",))


@query(
    f"SELECT k AS order_id, op, ts_ms, lsn FROM ({sql.events('orders')}) "
    "ORDER BY order_id, lsn, ts_ms, op LIMIT 10"
)
def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(bronze(spark, sf_dir, "orders"), "order_id")


@query(
    sql.union_all(
        [f"SELECT '{n}' AS \"table\", k, 'r' AS op, base_ms AS ts_ms FROM ({q})" for n, q in sql.BASE.items()]
        + [
            "SELECT 'order_items' AS \"table\", l_orderkey * 10 + l_linenumber AS k, 'r' AS op, epoch_ms(l_shipdate) AS ts_ms "
            "FROM lineitem"
        ]
    )
)
def snapshot_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of all four captured tables; the versions of an item stand for as many rows."""
    items = order_item_events(table(spark, sf_dir, "lineitem")).select("before.*", F.col("ts_ms").alias("base_ms"))
    frames = {n: base_rows(spark, sf_dir, n) for n in sql.BASE} | {"order_items": items}

    def events(name: str, rows: DataFrame) -> DataFrame:
        key = TABLES[name].key
        made = snapshot_events(rows, name, F.col("base_ms"), F.col(key) * 10)
        return made.select(F.col("source.table").alias("table"), event_key(key).alias("k"), "op", "ts_ms")

    return _union([events(n, rows) for n, rows in frames.items()])


@query(f"SELECT k, op, ts_ms, status FROM ({sql.events('orders')})")
def decode_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_envelopes(bronze(spark, sf_dir, "orders"), "order_id")
    return decode(messages, ORDERS.image).select(event_key("order_id").alias("k"), "op", "ts_ms", "after.status")


# One row in fifty names another table than the one it landed in.
STRAY = {"customers": "payments", "products": "customers", "orders": "order_items", "order_items": "orders"}


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def one(name: str) -> DataFrame:
        log = bronze(spark, sf_dir, name)
        stray = F.when(event_key(TABLES[name].key) % 50 == 0, STRAY[name]).otherwise(F.col("source.table"))
        return log.select(
            F.lit(name).alias("target"), F.col("source").withField("table", stray).alias("source"), "op"
        )

    return _union([one(n) for n in TABLES])


LANDED_SQL = sql.union_all(
    [
        f"SELECT '{n}' AS target, CASE WHEN k % 50 = 0 THEN '{STRAY[n]}' ELSE '{n}' END AS source_table "
        f"FROM ({sql.events(n)})"
        for n in TABLES
    ]
)


def _by_pair(events: DataFrame, target: Column) -> DataFrame:
    return events.groupBy(target.alias("target"), F.col("source.table").alias("source_table")).agg(
        F.count("*").alias("n")
    )


@query(
    f"SELECT target, source_table, count(*) AS n FROM ({LANDED_SQL}) "
    "WHERE source_table IN ('customers', 'orders') GROUP BY ALL"
)
def capture_include_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_pair(routing.include_tables(_landed(spark, sf_dir), ["customers", "orders"]), F.col("target"))


@query(
    f"SELECT source_table AS target, source_table, count(*) AS n FROM ({LANDED_SQL}) "
    "WHERE source_table <> 'payments' GROUP BY ALL"
)
def route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = routing.route(_landed(spark, sf_dir), TABLES)
    return _union([_by_pair(events, F.lit(target)) for target, events in targets.items()])


@query(
    f"SELECT target, source_table, count(*) AS n FROM ({LANDED_SQL}) WHERE target <> source_table GROUP BY ALL"
)
def misroute_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.misrouted(_landed(spark, sf_dir))


@query(
    "SELECT target, target AS source_table, count(*) AS n FROM ("
    + sql.union_all([f"SELECT '{n}' AS target FROM ({sql.events(n)})" for n in TABLES])
    + ") GROUP BY ALL"
)
def drop_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delete is followed by a message without a value; only the events remain."""

    def one(name: str) -> DataFrame:
        log = bronze(spark, sf_dir, name)
        empties = F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        return log.withColumn("empty", F.explode(empties)).select(
            F.lit(name).alias("target"),
            "source",
            F.when(~F.col("empty"), F.to_json(F.struct("before", "after", "op", "ts_ms", "source"))).alias("value"),
        )

    return _by_pair(without_tombstones(_union([one(n) for n in TABLES])), F.col("target"))


@query(
    """SELECT p_partkey AS k, 'SKU-' || p_partkey AS sku, CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
              CASE WHEN p_partkey % 2 = 1 THEN p_type END AS category,
              CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand
       FROM part"""
)
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old version has int prices and a brand, the new one bigint prices and a category."""
    k = F.col("product_id")
    parts = base_rows(spark, sf_dir, "products")
    brands = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.round(F.col("p_retailprice") * 100).cast("int").alias("price_cents"),
        F.col("p_brand").alias("brand"),
    )
    old = brands.where("k % 2 = 0")
    new = parts.where(k % 2 == 1).select(k.alias("k"), "sku", "price_cents", "category")
    return union_versions(old, new)


@query(
    f"""SELECT k, CAST(count(*) FILTER (has_after) AS BIGINT) AS from_after,
               CAST(count(*) FILTER (NOT has_after) AS BIGINT) AS from_before
        FROM ({sql.events('orders')}) GROUP BY k"""
)
def key_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover_keys(bronze(spark, sf_dir, "orders"), "order_id")


# Renderings of a time, by order key modulo 12: pattern and whether it is a date-time that may be read.
ISO_FORMS = (
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "ms"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "ms"),
    ("yyyy-MM-dd'T'HH:mm:ss'+05:30'", "ms - 19800000"),
    ("yyyy-MM-dd'T'HH:mm:ss'-0800'", "ms + 28800000"),
    ("yyyy-MM-dd'T'HH:mm'Z'", "ms"),
    ("yyyy-MM-dd", "ms"),
    ("yyyy-MM-dd'T'HH:mm:ss", "ms"),
    ("yyyy-MM-dd HH:mm:ss", "NULL"),
    ("'T'HH:mm:ss", "NULL"),
    ("yyyyMMdd'T'HHmmss'Z'", "NULL"),
    ("yyyy-MM'-45T'HH:mm:ss'Z'", "NULL"),
    ("'not a time'", "NULL"),
)


@query(
    "SELECT k, epoch_ms, epoch_ms IS NULL AS is_null FROM (SELECT k, CAST(CASE k % 12 "
    + " ".join(f"WHEN {i} THEN {value}" for i, (_, value) in enumerate(ISO_FORMS))
    + " END AS BIGINT) AS epoch_ms FROM (SELECT o_orderkey AS k, epoch_ms(o_orderdate) AS ms FROM orders))"
)
def iso8601_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = reduce(
        lambda case, form: case.when(k % 12 == form[0], F.date_format("o_orderdate", form[1][0])),
        enumerate(ISO_FORMS),
        F.when(F.lit(False), ""),
    )
    return (
        table(spark, sf_dir, "orders")
        .select(k.alias("k"), F.unix_millis(parse_iso8601(text)).alias("epoch_ms"))
        .withColumn("is_null", F.col("epoch_ms").isNull())
    )


@query(
    f"""WITH base AS (SELECT k, min(customer_id) AS customer_id, min(status) AS status, count(*) AS n
                      FROM ({sql.BASE['orders']}) GROUP BY k),
             old AS (SELECT k, customer_id, status, n FROM base WHERE k % 7 <> 0),
             new AS (SELECT k, CASE WHEN k % 23 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id,
                            CASE WHEN k % 3 = 0 THEN 'cancelled' WHEN k % 17 = 0 THEN NULL ELSE status END AS status,
                            CASE WHEN k % 5 = 0 THEN 'web' END AS channel, n
                     FROM base WHERE k % 11 <> 0)
        SELECT k, op, old_status, new_status, channel FROM (
          SELECT coalesce(o.k, n.k) AS k,
                 CASE WHEN o.n > 1 OR n.n > 1 THEN '?' WHEN o.k IS NULL THEN 'c' WHEN n.k IS NULL THEN 'd'
                      WHEN o.status IS DISTINCT FROM n.status OR o.customer_id IS DISTINCT FROM n.customer_id
                           OR n.channel IS NOT NULL THEN 'u' END AS op,
                 o.status AS old_status, n.status AS new_status, n.channel AS channel
          FROM old o FULL JOIN new n ON o.k = n.k)
        WHERE op IS NOT NULL"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the orders, and one that only the new snapshot has."""
    k = F.col("order_id")
    rows = base_rows(spark, sf_dir, "orders").drop("base_ms")
    status = F.when(k % 3 == 0, "cancelled").when(k % 17 == 0, F.lit(None)).otherwise(F.col("status"))
    customer = F.when(k % 23 == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id"))
    new = rows.where(k % 11 != 0).withColumns(
        {"status": status, "customer_id": customer, "channel": F.when(k % 5 == 0, "web")}
    )
    return diff(rows.where(k % 7 != 0), new, "order_id").select(
        "k", "op", F.col("before.status").alias("old_status"), F.col("after.status").alias("new_status"), "after.channel"
    )


@query(
    f"""WITH base AS (SELECT k, min(customer_id) AS customer_id, min(status) AS status, count(*) AS n
                      FROM ({sql.BASE['orders']}) GROUP BY k),
             old AS (SELECT * FROM base WHERE k % 1000 NOT BETWEEN 120 AND 124),
             new AS (SELECT k, customer_id, CASE WHEN k % 1000 BETWEEN 40 AND 60 AND k % 3 = 0 THEN 'cancelled' ELSE status END AS status, n
                     FROM base WHERE k % 1000 NOT BETWEEN 100 AND 110)
        SELECT coalesce(o.k, n.k) AS k, o.status AS old_status, n.status AS new_status,
               CASE WHEN o.n > 1 OR n.n > 1 THEN '?' WHEN o.k IS NULL THEN 'c' WHEN n.k IS NULL THEN 'd' ELSE 'u' END AS op
        FROM old o FULL JOIN new n ON o.k = n.k WHERE o.status IS DISTINCT FROM n.status OR o.n IS DISTINCT FROM n.n"""
)
def snapshot_diff_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots that differ in a few ranges of keys only."""
    k = F.col("order_id")
    rows = base_rows(spark, sf_dir, "orders").drop("base_ms")
    status = F.when((k % 1000).between(40, 60) & (k % 3 == 0), "cancelled").otherwise(F.col("status"))
    new = rows.where(~(k % 1000).between(100, 110)).withColumn("status", status)
    found = diff_by_range(rows.where(~(k % 1000).between(120, 124)), new, "order_id")
    return found.select("k", "op", F.col("before.status").alias("old_status"), F.col("after.status").alias("new_status"))


@query(
    f"""WITH wanted AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 97 = 0),
             came AS (SELECT k, count(*) AS n FROM ({sql.events('orders')})
                      WHERE has_after AND status = 'shpped' GROUP BY k)
        SELECT 'order-' || w.k AS marker, 'shpped' AS expected, coalesce(n, 0) AS arrived,
               CASE WHEN coalesce(n, 0) > 0 THEN 'arrived' ELSE 'waiting' END AS verdict
        FROM wanted w LEFT JOIN came USING (k)"""
)
def arrival_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    expected = (
        table(spark, sf_dir, "orders").where(k % 97 == 0).select(k.alias("order_id"), F.lit("shpped").alias("status"))
    )
    return check_arrival(expected, bronze(spark, sf_dir, "orders"), "order_id", "status").select(
        F.concat(F.lit("order-"), F.col("order_id").cast("string")).alias("marker"),
        F.col("status").alias("expected"),
        "arrived",
        "verdict",
    )


@query(
    """SELECT marker, CAST(1 AS BIGINT) AS expected, arrived,
              CASE arrived WHEN 0 THEN 'lost' WHEN 1 THEN 'ok' ELSE 'duplicated' END AS verdict
       FROM (SELECT 'marker-' || c_custkey || '@example.com' AS marker,
                    CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS arrived
             FROM customer WHERE c_custkey % 97 = 0)"""
)
def marker_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker customers of which the transport lost every fourth and repeated every fifth."""
    k = F.col("customer_id")
    marker = F.concat(F.lit("marker-"), k.cast("string"), F.lit("@example.com"))
    rows = base_rows(spark, sf_dir, "customers")
    expected = rows.where(k % 97 == 0).select(marker.alias("marker"), F.lit(1).cast("bigint").alias("expected"))
    copies = F.when(k % 97 != 0, 1).when(k % 4 == 0, 0).when(k % 5 == 0, 2).otherwise(1)
    sent = rows.withColumn("email", F.when(k % 97 == 0, marker).otherwise(F.col("email")))
    arrived = snapshot_events(
        sent.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))),
        "customers",
        F.col("base_ms"),
        k * 10,
    )
    return reconcile_markers(expected, arrived, "email", "marker-")
