"""Throughput and lag of streams from the progress that Spark reports, as gauges beside those of the batch jobs."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changeflow.plans.jobs import RUN_METRICS
from changeflow.plans.tables import create_namespaces

log = logging.getLogger(__name__)


def backlog(progress: Mapping[str, Any]) -> int | None:
    """Messages that the topics held beyond what the batch read; None for sources that do not tell."""
    behind = None
    for source in progress.get("sources", []):
        latest, read = (_offsets(source.get(which)) for which in ("latestOffset", "endOffset"))
        for topic, partitions in latest.items():
            for partition, end in partitions.items():
                behind = (behind or 0) + max(0, int(end) - int(read.get(topic, {}).get(partition, 0)))
    return behind


def _offsets(reported: Any) -> dict[str, dict[str, int]]:
    """Offsets by topic and partition; what other sources report as their position is none."""
    if isinstance(reported, str):
        try:
            reported = json.loads(reported)
        except ValueError:
            return {}
    if not isinstance(reported, Mapping):
        return {}
    return {t: dict(p) for t, p in reported.items() if isinstance(p, Mapping)}


def gauges(progress: Mapping[str, Any]) -> dict[str, float]:
    """What a batch's report says, as values by metric."""
    values = {
        "input_rows": progress.get("numInputRows"),
        "batch_seconds": progress.get("durationMs", {}).get("triggerExecution", 0) / 1000,
        "rows_per_second": progress.get("processedRowsPerSecond"),
        "backlog": backlog(progress),
    }
    return {k: float(v) for k, v in values.items() if v is not None}


class ProgressRecorder(StreamingQueryListener):
    """Appends the gauges of every batch to the metrics table, under the name of its stream.

    Register it with ``spark.streams.addListener``. Reports are written ``every`` so many batches and when a stream
    ends. Nothing that goes wrong here reaches the stream: it is logged, and the reports are dropped.
    """

    def __init__(self, spark: SparkSession, every: int = 6) -> None:
        self.spark, self.every = spark, every
        self.held: list[tuple[str, str, str, float, str]] = []
        self.batches = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            progress = json.loads(event.progress.json)
            # batch numbers with leading zeros, so that runs sort by time
            run, job = f"{progress['runId']}/{progress['batchId']:012d}", progress.get("name") or progress["id"]
            self.held += [(run, job, metric, value, progress["timestamp"]) for metric, value in gauges(progress).items()]
            self.batches += 1
            if self.batches >= self.every:
                self.write()
        except Exception:
            log.warning("could not note the progress of a stream", exc_info=True)

    def onQueryTerminated(self, event) -> None:
        try:
            self.write()
        except Exception:
            log.warning("could not record the progress of a stream", exc_info=True)

    def write(self) -> None:
        rows, self.held, self.batches = self.held, [], 0
        if rows:
            create_namespaces(self.spark, ["ops"])
            frame = self.spark.createDataFrame(rows, "run string, job string, metric string, value double, at string")
            frame = frame.select("run", "job", "metric", "value", F.to_timestamp("at").alias("ts"))
            frame.coalesce(1).write.mode("append").saveAsTable(RUN_METRICS)
