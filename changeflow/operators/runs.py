"""Run, lag and latency metrics as tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.quantiles import exact_percentiles


def latest_status(metrics: DataFrame, sequence: str) -> DataFrame:
    """The newest value per job and metric; ``sequence``, a non-negative bigint or a run's name, orders rows of equal time.

    Time and a number are packed into one decimal: a fixed-width order lets Spark keep the running best in a
    hash table, where a struct or a name makes every task sort its rows.
    """
    if metrics.schema[sequence].dataType.typeName() == "string":
        order = F.struct("ts", sequence)
    else:
        packed = F.unix_micros("ts").cast("decimal(38,0)") * F.lit(Decimal(10) ** 19) + F.col(sequence)
        order = packed.cast("decimal(38,0)")
    return metrics.groupBy("job", "metric").agg(F.max_by("value", order).alias("value"))


def duration_series(metrics: DataFrame, metric: str) -> DataFrame:
    return metrics.where(F.col("metric") == metric).select("ts", "job", "value")


def failed_tests(results: DataFrame) -> DataFrame:
    """Tests per job that neither passed nor were skipped; models do not count."""
    failed = (F.col("kind") == "test") & ~F.col("status").isin("pass", "skipped")
    return results.groupBy("job").agg(F.count_if(failed).alias("value"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not yet consumed per group and topic.

    ``ends`` has (grp, topic, partition, end_offset), ``committed`` (grp, topic, partition,
    committed_offset); a partition that was never committed lags by its whole length.
    """
    behind = F.greatest(F.col("end_offset") - F.coalesce("committed_offset", F.lit(0)), F.lit(0))
    return (
        ends.join(committed, ["grp", "topic", "partition"], "left")
        .groupBy("grp", "topic")
        .agg(F.sum(behind).alias("lag"))
    )


def topic_offsets(spark: SparkSession, grp: str, progress: Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """End and committed offsets of a stream over topics, from its progress report, for :func:`consumer_lag`."""

    def frame(which: str, column: str) -> DataFrame:
        rows = [
            (grp, topic, int(partition), int(offset))
            for source in progress["sources"]
            for topic, partitions in _offsets(source.get(which)).items()
            for partition, offset in partitions.items()
        ]
        return spark.createDataFrame(rows, f"grp string, topic string, partition int, {column} bigint")

    return frame("latestOffset", "end_offset"), frame("endOffset", "committed_offset")


def _offsets(reported: Any) -> Mapping[str, Mapping[str, int]]:
    return (json.loads(reported) if isinstance(reported, str) else reported) or {}


def latency_percentiles(events: DataFrame) -> DataFrame:
    """Median and 95th percentile of ``ingest_ms - source_ms``."""
    return exact_percentiles(
        events.select((F.col("ingest_ms") - F.col("source_ms")).alias("latency")), "latency", {"p50": 0.5, "p95": 0.95}
    )
