"""Queries for current state and the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.current_state import current_state, deleted_keys
from changeflow.operators.skew import hot_keys
from changeflow.plans import gold, silver
from changeflow.plans.shop import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, ShopTable
from changeflow.sources.capture import chunk_of, merge_snapshot, snapshot_envelopes
from changeflow.sources.envelope import event_key
from changeflow.workload import sql
from changeflow.workload.derive import bronze, hot_customer_log, iso
from changeflow.workload.registry import query


def in_millis(df: DataFrame) -> DataFrame:
    """Times as epoch milliseconds, which every engine compares alike."""
    return df.withColumns({c: F.unix_millis(c) for c, t in df.dtypes if t == "timestamp"})


def silver_of(spark: SparkSession, sf_dir: str, table: ShopTable) -> DataFrame:
    return silver.silver(bronze(spark, sf_dir, table.name), table)


def gold_of(spark: SparkSession, sf_dir: str, models: dict[str, DataFrame] | None = None) -> DataFrame:
    models = models or {t.name: silver_of(spark, sf_dir, t) for t in (ORDERS, CUSTOMERS, ORDER_ITEMS)}
    return gold.gold_order_summary(
        models["orders"],
        models["customers"],
        models["order_items"],
        hot_keys(hot_customer_log(spark, sf_dir), "customer_id"),
    )


@query(sql.silver("customers"))
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(silver_of(spark, sf_dir, CUSTOMERS))


@query(sql.silver("products"))
def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(silver_of(spark, sf_dir, PRODUCTS))


@query(sql.silver("orders"))
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(silver_of(spark, sf_dir, ORDERS))


@query(sql.silver("order_items"))
def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(silver_of(spark, sf_dir, ORDER_ITEMS))


@query(f"SELECT k, ts_ms FROM ({sql.latest('orders')}) WHERE op = 'd'")
def silver_deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_keys(bronze(spark, sf_dir, "orders"), "order_id").withColumnRenamed("order_id", "k")


@query(sql.silver("orders"))
def latest_by_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(silver.silver_by_max(bronze(spark, sf_dir, "orders"), ORDERS))


@query(sql.silver("orders"))
def duplicate_absorption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event is delivered three times."""
    copies = F.when(F.col("source.lsn") % 3 == 0, 3).otherwise(1)
    log = bronze(spark, sf_dir, "orders").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return in_millis(silver.silver_orders(log))


@query(sql.silver("orders"))
def out_of_order_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest events first, so that within a task every older one arrives late."""
    log = bronze(spark, sf_dir, "orders").sortWithinPartitions(F.desc("ts_ms"))
    return in_millis(silver.silver_orders(log))


@query(sql.silver("orders"))
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reset capture sends the current rows again, later than anything before."""
    log = bronze(spark, sf_dir, "orders")
    rows = silver.silver_orders(log)
    as_text = rows.withColumns({c: F.expr(iso(f"unix_millis({c})")) for c in ORDERS.times})
    later = F.lit(4_000_000_000_000)
    replay = snapshot_envelopes(as_text, "orders", later, F.lit(9_000_000_000_000_000))
    return in_millis(silver.silver_orders(log.unionByName(replay)))


@query(
    f"""SELECT o.order_id, o.status, c.full_name AS customer_name
        FROM ({sql.silver('orders')}) o LEFT JOIN ({sql.silver('customers')}) c USING (customer_id)"""
)
def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = gold.orders_with_customer(
        silver_of(spark, sf_dir, ORDERS),
        silver_of(spark, sf_dir, CUSTOMERS),
        hot_keys(hot_customer_log(spark, sf_dir), "customer_id"),
    )
    return joined.select("order_id", "status", "customer_name")


@query(sql.gold())
def gold_order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_millis(gold_of(spark, sf_dir))


#: Keys of a chunk, when the log that is still there begins, and how far chunks and the ends of their windows are apart.
CHUNK, LOG_FROM, CHUNK_MS, WINDOW_MS = 500, 788_918_400_000, 86_400_000 * 9, 86_400_000 * 400


def chunked_snapshot(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the orders as the readers of their chunks saw them, the chunks' windows, and the log since the first.

    A row that is inserted in its chunk's window is seen half a minute later, before its updates; others halfway through.
    """
    key = event_key(ORDERS.key)
    low = F.lit(LOG_FROM) + F.pmod(F.col("chunk"), F.lit(40)) * CHUNK_MS
    at = [F.struct((low + i * WINDOW_MS).alias("ts_ms"), F.lit(0).cast("bigint").alias("lsn")).alias(n) for i, n in enumerate(("low", "high"))]
    log = log.withColumns({"key": key, "chunk": chunk_of(key, CHUNK)})
    windows = log.select("chunk").distinct().select("chunk", *at)
    begun = log.where("op IN ('r', 'c')").groupBy("key").agg(F.min("ts_ms").alias("begun"))
    half = F.col("low.ts_ms") + WINDOW_MS // 2
    inside = (F.col("begun") >= F.col("low.ts_ms")) & (F.col("begun") < F.col("high.ts_ms") - 60_000)
    seen = log.join(windows, "chunk").join(begun, "key").where(F.col("ts_ms") <= F.when(inside, F.col("begun") + 30_000).otherwise(half))
    rows = current_state(seen, ORDERS.key, ORDERS.columns)
    return rows, windows, log.where(F.col("ts_ms") >= LOG_FROM).drop("key", "chunk")


@query(sql.silver("orders"))
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the log is lost; chunks were read at different times, so many rows are stale or ahead of it."""
    rows, windows, log = chunked_snapshot(bronze(spark, sf_dir, "orders"))
    return in_millis(silver.silver_orders(merge_snapshot(rows, windows, log, ORDERS.key, CHUNK, "orders")))


__all__ = ["PRODUCTS", "gold_of", "in_millis", "silver_of"]
