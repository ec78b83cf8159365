"""Change topics as streaming frames with ``key`` and ``value`` text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE = "key string, value string"
POSITIONED = f"{MESSAGE}, topic string, partition int, offset bigint"


def topic_name(table: str, prefix: str = "shop", schema: str = "shop") -> str:
    return f"{prefix}.{schema}.{table}"


def subscribe_kafka(
    spark: SparkSession, servers: str, topic: str, binary: bool = False, **options: str
) -> DataFrame:
    """One topic from Kafka; needs the Spark Kafka package on the cluster. ``binary`` leaves values as bytes."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .selectExpr(
            "cast(key as string) as key",
            "value" if binary else "cast(value as string) as value",
            "topic",
            "partition",
            "offset",
        )
    )


def subscribe_files(
    spark: SparkSession, path: str, files_per_batch: int = 1000, schema: str = MESSAGE
) -> DataFrame:
    """Messages dropped as parquet files into a folder, with their position if ``schema`` is ``POSITIONED``."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
