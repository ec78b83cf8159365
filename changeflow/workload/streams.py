"""Queries that drain ``lineitem`` and ``part`` as streams of change events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.plans.shop import ORDER_ITEMS, ShopTable
from changeflow.plans.silver import silver
from changeflow.session import remove_dir, shared_dir
from changeflow.sources.capture import snapshot_envelopes
from changeflow.sources.decode import encode_envelopes
from changeflow.sources.envelope import op_counts
from changeflow.sources.topics import subscribe_files
from changeflow.streaming.bronze import append, land
from changeflow.streaming.state import maintain, read_current
from changeflow.workload import sql
from changeflow.workload.derive import base_rows, order_item_events, stream_table, table
from changeflow.workload.registry import query

#: Micro-batches that the state is built from.
BATCHES = 6
#: Events of a file, about; a batch has as many files as it needs.
FILE_EVENTS = 1 << 19


@query(f"SELECT op, count(*) AS n FROM ({sql.events('order_items')}) GROUP BY op")
def stream_bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "bronze")
    events = order_item_events(stream_table(spark, sf_dir, "lineitem"))
    append(events, f"{root}/order_items", f"{root}/checkpoint", available_now=True).awaitTermination()
    remove_dir(spark, f"{root}/checkpoint")
    return op_counts(spark.read.schema(events.schema).parquet(f"{root}/order_items"))


@query(sql.silver("order_items"))
def stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come in any order over several batches, so many are late and meet stored rows."""
    root, target = shared_dir(spark, "state"), f"default.state_{uuid.uuid4().hex}"
    events = order_item_events(table(spark, sf_dir, "lineitem"))
    parts = BATCHES * max(1, -(-events.count() // (BATCHES * FILE_EVENTS)))
    events.repartition(parts, "before", "ts_ms").write.parquet(f"{root}/events")
    files = len(spark.read.parquet(f"{root}/events").inputFiles())
    per_batch = max(1, -(-files // BATCHES))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{root}/events")
    maintain(stream, ORDER_ITEMS, target, f"{root}/checkpoint", True).awaitTermination()
    remove_dir(spark, root)
    return read_current(spark, ORDER_ITEMS, target)


# The product stream before and after its row image grew and a number widened.
OLD_IMAGE = ShopTable("products", "product_id", "product_id bigint, price_cents int", ("price_cents",))
NEW_IMAGE = ShopTable(
    "products", "product_id", "product_id bigint, price_cents bigint, sku string", ("price_cents", "sku")
)


@query(
    f"""SELECT k AS product_id, CASE WHEN k % 3 = 1 THEN price_cents + 5000000000 ELSE price_cents END AS price_cents,
               CASE WHEN k % 3 = 1 THEN sku END AS sku
        FROM ({sql.BASE['products']})"""
)
def stream_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old images, new ones and old ones again, landed into one table; all of it is read in the new shape."""
    root, target = shared_dir(spark, "evolution"), f"default.landed_{uuid.uuid4().hex}"
    rows = base_rows(spark, sf_dir, "products")
    k = F.col("product_id")
    for i, image in enumerate((OLD_IMAGE, NEW_IMAGE, OLD_IMAGE)):
        price = F.col("price_cents") + 5_000_000_000 if image is NEW_IMAGE else F.col("price_cents").cast("int")
        sent = rows.where(k % 3 == i).withColumn("price_cents", price)
        events = snapshot_envelopes(sent.select("product_id", *image.columns), "products", k * 1000, k * 10)
        encode_envelopes(events, "product_id").write.parquet(f"{root}/topic{i}")
        messages = subscribe_files(spark, f"{root}/topic{i}")
        land(messages, image, target, f"{root}/checkpoint{i}", available_now=True).awaitTermination()
    remove_dir(spark, root)
    return silver(spark.table(target), NEW_IMAGE)
