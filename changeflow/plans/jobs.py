"""The batch jobs: build all models, check the mart, record the run."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import audit
from changeflow.operators import expectations as ex
from changeflow.operators.runs import latest_status
from changeflow.plans.checks import GOLD_CHECKS
from changeflow.plans.gold import GOLD_ORDER_SUMMARY, gold_order_summary
from changeflow.plans.shop import TABLES
from changeflow.plans.silver import silver
from changeflow.plans.tables import Published, block, create_namespaces, model_name, promote, stage
from changeflow.session import use_utc

log = logging.getLogger(__name__)

RUN_METRICS = "ops.run_metrics"
METRIC_ROW = "run string, job string, metric string, value double, ts timestamp"


@dataclass
class RunMetrics:
    values: dict[str, float]


@contextmanager
def recorded(spark: SparkSession, job: str, run: str) -> Iterator[RunMetrics]:
    """Record duration and success of a job, and what else it notes, whether it fails or not."""
    noted = RunMetrics({})
    start = time.time()
    success = 0.0
    try:
        yield noted
        success = 1.0
    finally:
        record_metrics(spark, job, run, {"duration_seconds": time.time() - start, "success": success, **noted.values})


def record_metrics(spark: SparkSession, job: str, run: str, values: dict[str, float]) -> None:
    """Append a run's gauges to the metrics table. A failure here never changes the run's outcome."""
    try:
        create_namespaces(spark, ["ops"])
        rows = [(run, job, metric, float(value)) for metric, value in values.items()]
        spark.createDataFrame(rows, "run string, job string, metric string, value double").withColumn(
            "ts", F.current_timestamp()
        ).write.mode("append").saveAsTable(RUN_METRICS)
    except Exception:
        log.warning("could not record metrics of %s", job, exc_info=True)


def recorded_metrics(spark: SparkSession) -> DataFrame:
    """Gauges once per run, job and metric, though a retried run may have written them twice."""
    return (
        spark.table(RUN_METRICS)
        .groupBy("run", "job", "metric")
        .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
    )


def job_status(spark: SparkSession) -> DataFrame:
    """The latest gauges of every job, from the engine's own metrics; of equal times the later run counts."""
    return latest_status(recorded_metrics(spark), "run")


def failing(tests: DataFrame) -> DataFrame:
    """Column tests as a report: a test succeeds if it has no failures."""
    return tests.withColumn("success", F.col("failures") == 0)


def build_silver(spark: SparkSession, run: str, noted: RunMetrics) -> dict[str, Published]:
    """All of Silver is staged and tested before any of it is shown, so dependants never read what failed."""
    staged = {
        t.name: stage(silver(spark.table(f"bronze.{t.name}"), t), model_name(f"silver_{t.name}", "silver"), run)
        for t in TABLES.values()
    }
    gate(noted, "silver", audit.column_tests({f"silver_{n}": spark.table(s.version) for n, s in staged.items()}))
    return {n: promote(spark, s) for n, s in staged.items()}


def gate(noted: RunMetrics, model: str, tests: DataFrame) -> None:
    """Note how many column tests failed, and stop if any did."""
    report = failing(tests)
    noted.values["test_failures"] = noted.values.get("test_failures", 0) + report.where("NOT success").count()
    block(model, report)


def build_gold(spark: SparkSession, run: str, noted: RunMetrics) -> Published:
    """Published only if its shape matches the contract and all value checks and column tests hold."""
    mart = gold_order_summary(
        spark.table("silver.silver_orders"),
        spark.table("silver.silver_customers"),
        spark.table("silver.silver_order_items"),
    )
    model = model_name("gold_order_summary", "gold")
    staged = stage(mart, model, run, GOLD_ORDER_SUMMARY)
    rows = spark.table(staged.version)
    block(model, ex.report(rows, GOLD_CHECKS))
    gate(noted, model, audit.column_tests({"gold_order_summary": rows}))
    return promote(spark, staged)


def run_column_tests(spark: SparkSession) -> DataFrame:
    models = {f"silver_{t}": spark.table(f"silver.silver_{t}") for t in TABLES}
    return audit.column_tests(models | {"gold_order_summary": spark.table("gold.gold_order_summary")})


def build(spark: SparkSession, run: str, job: str = "build") -> Published:
    """Silver behind its column tests, then the mart behind its checks and tests."""
    use_utc(spark)
    create_namespaces(spark)
    with recorded(spark, job, run) as noted:
        build_silver(spark, run, noted)
        mart = build_gold(spark, run, noted)
        noted.values["rows"] = mart.rows
    return mart


def check_mart(spark: SparkSession, run: str, job: str = "quality_checks") -> bool:
    """Run the value checks on the published mart alone and record the verdict."""
    report = ex.report(spark.table("gold.gold_order_summary"), GOLD_CHECKS)
    with recorded(spark, job, run) as noted:
        ok = bool(ex.verdict(report).first()["success"])
        noted.values["check_success"] = float(ok)
    return ok
