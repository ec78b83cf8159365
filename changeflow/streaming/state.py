"""Current state kept up to date by a streaming aggregation.

The newest event of every key is the state of the aggregation, held by Spark's RocksDB state store. A micro-batch
gives the newest events of the keys that it touched; they become one partition of a table, by stream and batch, so a batch
that is run again takes the place of its first attempt. Whoever reads the table takes the newest event per key.
Deleted keys stay in it, or a late older event would bring a row back. No watermark: an event counts however late
it comes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.current_state import flat_events, newest_per_key
from changeflow.plans.shop import ShopTable
from changeflow.plans.silver import with_times
from changeflow.session import own_conf

# Spark's settings for its state store.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ONLY_OWN_PARTITIONS = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
#: The stream of partitions that :func:`compact` writes.
SETTLED = "settled"


def state_schema(table: ShopTable) -> T.StructType:
    image = T.StructType.fromDDL(table.image)
    order = [table.key, *table.columns]
    return T.StructType([image[c] for c in order] + T.StructType.fromDDL("op string, ts_ms bigint, lsn bigint").fields)


def create_state(spark: SparkSession, table: ShopTable, target: str) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state_schema(table))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({columns}, stream string, batch bigint) USING parquet PARTITIONED BY (stream, batch)")


def read_all(spark: SparkSession, table: ShopTable, target: str) -> DataFrame:
    """Newest event of every key, deleted ones included; empty if nothing was written yet."""
    if not spark.catalog.tableExists(target):
        return spark.createDataFrame([], state_schema(table))
    return newest_per_key(spark.table(target).drop("stream", "batch"), table.key, table.columns)


def read_current(spark: SparkSession, table: ShopTable, target: str) -> DataFrame:
    rows = read_all(spark, table, target).where("op <> 'd'").select(table.key, *table.columns)
    return with_times(rows, table)


def newest_events(envelopes: DataFrame, table: ShopTable) -> DataFrame:
    """The newest event of every key as an aggregate, which streams allow, in the columns of the state."""
    content = ", ".join(("ts_ms", "lsn", "op", *table.columns))
    newest = f"max_by(struct({content}), struct({content}))"
    flat = flat_events(envelopes, table.key, table.columns)
    return flat.groupBy(table.key).agg(F.expr(newest).alias("e")).selectExpr(table.key, *[f"e.{c}" for c in state_schema(table).names[1:]])


def write_batch(reader: SparkSession, table: ShopTable, target: str, stream: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes a batch's rows of the state as the partition of its stream and number.

    Batches run in a session of their own, so ``reader``, the one that started the stream, is told of new files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        create_state(batch.sparkSession, table, target)
        rows = batch.select(*state_schema(table).names, F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch"))
        with own_conf(batch.sparkSession, ONLY_OWN_PARTITIONS):
            rows.write.mode("overwrite").insertInto(target)
        reader.catalog.refreshTable(target)

    return write


def maintain(
    envelopes: DataFrame,
    table: ShopTable,
    target: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep the current state of one table from a stream of its envelopes.

    The checkpoint holds the aggregation's state. Without it the stream starts over under the same name: its
    batches replace those of before, and what they have not reached yet stands until then.
    """
    spark = envelopes.sparkSession
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
    writer = newest_events(envelopes, table).writeStream.outputMode("update")
    writer = writer.foreachBatch(write_batch(spark, table, target, stream)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    with own_conf(spark, STATE_STORE):
        return writer.start()


def compact(spark: SparkSession, table: ShopTable, target: str) -> None:
    """Write the newest events as one partition and drop those they came from.

    If it stops in between, events are there twice, which readers absorb; a reader that still lists dropped files
    has to start again.
    """
    found = [r.partition for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
    old = [dict(p.split("=", 1) for p in f.split("/")) for f in found]
    batch = 1 + max((int(p["batch"]) for p in old if p["stream"] == SETTLED), default=0)
    write_batch(spark, table, target, SETTLED)(read_all(spark, table, target), batch)
    for p in old:
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (stream = '{p['stream']}', batch = {p['batch']})")
    spark.catalog.refreshTable(target)
