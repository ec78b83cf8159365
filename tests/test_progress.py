"""Gauges of running streams."""

import time

import pytest
from pyspark.sql import functions as F

from changeflow.plans import jobs
from changeflow.streaming import progress
from changeflow.streaming.bronze import append
from changeflow.workload.derive import bronze


@pytest.fixture
def ops(spark):
    spark.sql("DROP SCHEMA IF EXISTS ops CASCADE")
    yield
    spark.sql("DROP SCHEMA IF EXISTS ops CASCADE")


def run(spark, tmp_path, listener, parts=3):
    events = bronze(spark, "/root/testdata/sf0.001", "orders")
    for i in range(parts):
        events.where(F.pmod(F.col("source.lsn"), F.lit(parts)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    spark.streams.addListener(listener)
    try:
        query = append(stream, str(tmp_path / "out"), str(tmp_path / "c"), available_now=True)
        query.awaitTermination()
        until = time.time() + 30
        while not getattr(listener, "ended", False) and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert query.exception() is None
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()
    return events.count(), str(query.id)


class Ending(progress.ProgressRecorder):
    def onQueryTerminated(self, event):
        super().onQueryTerminated(event)
        self.ended = True


@pytest.mark.parametrize("every", [1, 100])
def test_a_run_leaves_its_gauges(spark, ops, tmp_path, every):
    rows, name = run(spark, tmp_path, Ending(spark, every))
    found = spark.table(jobs.RUN_METRICS).where(F.col("job") == name)
    assert found.where("metric = 'input_rows' AND value > 0").count() == 3
    assert found.where("metric = 'input_rows'").agg(F.sum("value")).first()[0] == rows
    assert found.where("metric = 'batch_seconds' AND value > 0 AND ts IS NOT NULL").count() >= 3
    status = {r.metric: r.value for r in jobs.job_status(spark).where(F.col("job") == name).collect()}
    assert {"input_rows", "batch_seconds"} <= set(status) and "backlog" not in status


class Broken(Ending):
    def write(self):
        raise RuntimeError("no table")


def test_a_failing_recorder_stops_no_stream(spark, ops, tmp_path):
    run(spark, tmp_path, Broken(spark, 1))
    assert not spark.catalog.tableExists(jobs.RUN_METRICS)


@pytest.mark.parametrize(
    "sources, behind",
    [
        ([], None),
        ([{"latestOffset": None, "endOffset": None}, {"latestOffset": '{"logOffset":3}', "endOffset": '{"logOffset":3}'}], None),
        ([{"latestOffset": {"t": {"0": 12, "1": 7}}, "endOffset": '{"t": {"0": 10}}'}], 9),
        ([{"latestOffset": {"t": {"0": 5}}, "endOffset": {"t": {"0": 9}}}, {"latestOffset": '{"u":{"3":4}}', "endOffset": "{}"}], 4),
        ([{"latestOffset": "no json", "endOffset": "{"}], None),
    ],
)
def test_backlog_of_a_report(sources, behind):
    assert progress.backlog({"sources": sources}) == behind


def test_gauges_of_a_sparse_report():
    assert progress.gauges({"numInputRows": 0}) == {"input_rows": 0.0, "batch_seconds": 0.0}
