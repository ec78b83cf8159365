"""Topics into raw tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changeflow.operators.contracts import quarantine
from changeflow.operators.evolve import to_schema
from changeflow.plans.shop import ShopTable
from changeflow.plans.tables import raw_version
from changeflow.session import remove_dir
from changeflow.sources.decode import beyond, decode_envelopes, drop_tombstones, position
from changeflow.sources.envelope import envelope_schema

COMMIT_INTERVAL = "10 seconds"


def land(
    messages: DataFrame, table: ShopTable, target: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append one topic to one raw table, which is created on first use and grows with the row image.

    Every event is kept as it came, with its position in the topic; fields of the image that the table does
    not list are kept by name in ``rest``. The stream resumes from ``checkpoint`` after any stop; without it
    the topic is read again, which current state absorbs. A record that does not parse stops the stream. A
    ``target`` with a slash is a folder of parquet files, which readers open with the schema they want.
    """
    keep = position(messages) | {"rest": beyond(table.image)}
    events = decode_envelopes(messages, table.image, keep=keep)
    events = events.withColumn("ingest_ms", F.unix_millis(F.current_timestamp()))
    if "/" in target:
        return append(events, target, checkpoint, available_now)
    insert = _once(messages.sparkSession, checkpoint)
    writer = events.writeStream.foreachBatch(lambda batch, batch_id: insert(batch, batch_id, target))
    return _started(writer.option("checkpointLocation", checkpoint), available_now).start()


def _once(reader: SparkSession, checkpoint: str) -> Callable[[DataFrame, int, str], None]:
    """Insert a batch's rows into a raw table, tagged with their stream and batch.

    Only the first batch of a started stream can be one that was written before; that one is looked up. Batches
    run in a session of their own, so ``reader``, the one that started the stream, is told of new files.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
    seen: dict[str, int] = {}

    def insert(rows: DataFrame, batch_id: int, target: str) -> None:
        spark = rows.sparkSession
        rows = rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
        version = raw_version(spark, target, rows.schema)
        first = seen.setdefault(target, batch_id) == batch_id
        mine = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
        if not first or spark.table(target).where(mine).isEmpty():
            to_schema(rows, spark.table(version).schema).write.insertInto(version)
            reader.catalog.refreshTable(version)

    return insert


def land_or_quarantine(
    messages: DataFrame,
    table: ShopTable,
    target: str,
    quarantine_target: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Like :func:`land`, but a message that does not parse or breaks the table's contract is set aside.

    It goes to ``quarantine_target`` as it came, with the field at fault (``*`` for the whole message), and
    the rest of its batch lands. A batch that is run again finds what it has written by its number.
    """
    split = _split(messages.sparkSession, table, target, quarantine_target, checkpoint.rstrip("/"))
    writer = messages.writeStream.foreachBatch(split)
    return _started(writer.option("checkpointLocation", checkpoint), available_now).start()


def _split(
    reader: SparkSession, table: ShopTable, target: str, quarantine_target: str, checkpoint: str
) -> Callable[[DataFrame, int], None]:
    schema = envelope_schema(table.image).add("_corrupt_record", "string")
    image = F.coalesce(F.get_json_object("message", "$.after"), F.get_json_object("message", "$.before"))
    insert = _once(reader, checkpoint)

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = {name: F.col(name) for name in position(batch)}
        images = drop_tombstones(batch).select(
            "key",
            F.col("value").alias("message"),
            F.lit(table.name).alias("subject"),
            image.alias("value"),
            *[c.alias(name) for name, c in position(batch).items()],
            beyond(table.image).alias("rest"),
        )
        checked = (
            quarantine(images, {table.name: table.image})
            .withColumn("e", F.from_json("message", schema))
            .withColumn("good", F.expr("verdict = 'accepted' AND e._corrupt_record IS NULL"))
        )
        # judged once, read twice
        aside = f"{checkpoint}/checked/{batch_id}"
        checked.write.mode("overwrite").parquet(aside)
        checked = spark.read.schema(checked.schema).parquet(aside)
        good = checked.where("good").select(
            *[f"e.{c}" for c in ("before", "after", "op", "ts_ms", "source")],
            *kept.values(),
            "rest",
            F.unix_millis(F.current_timestamp()).alias("ingest_ms"),
        )
        insert(good, batch_id, target)
        insert(checked.where("NOT good").select("key", F.col("message").alias("value"), "field"), batch_id, quarantine_target)
        remove_dir(spark, aside)

    return split


def _started(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=COMMIT_INTERVAL)


def append(events: DataFrame, target: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to a table, or to a parquet folder when ``target`` is a path."""
    writer = _started(events.writeStream.outputMode("append").option("checkpointLocation", checkpoint), available_now)
    return writer.format("parquet").start(target) if "/" in target else writer.toTable(target)
