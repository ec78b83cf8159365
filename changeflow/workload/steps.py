"""The mart kept in step with batches of events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.plans.incremental import SOURCES, IncrementalMart, apply_batch, read_mart
from changeflow.workload import sql
from changeflow.workload.derive import bronze
from changeflow.workload.registry import query
from changeflow.workload.state import in_millis

#: Batches that the logs are dealt into, in no order, so that many events come late.
BATCHES = 3


@query(sql.gold())
def incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = IncrementalMart(f"steps_{uuid.uuid4().hex}")
    dealt = F.pmod(F.xxhash64("before", "after", "ts_ms"), F.lit(BATCHES))
    logs = {t.name: bronze(spark, sf_dir, t.name).withColumn("dealt", dealt) for t in SOURCES}
    for batch in range(BATCHES):
        apply_batch(spark, mart, batch, {n: log.where(F.col("dealt") == batch).drop("dealt") for n, log in logs.items()})
    return in_millis(read_mart(spark, mart))
