"""Queries over run metrics, consumer offsets and latencies derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions import sketches
from changeflow.operators import positions, runs
from changeflow.session import materialise
from changeflow.workload.derive import table
from changeflow.workload.registry import query

METRICS_SQL = """
    SELECT event_id, ts, event_type AS job,
           CASE user_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'duration_seconds' ELSE 'check_success' END AS metric,
           CASE WHEN user_id % 3 = 1 THEN value WHEN value < 5 THEN 0.0 ELSE 1.0 END AS value
    FROM events"""


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauges as pushed by jobs: one job per event type, one metric per user group."""
    group = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("job"),
        F.when(group == 0, "success").when(group == 1, "duration_seconds").otherwise("check_success").alias("metric"),
        F.when(group == 1, F.col("value")).when(F.col("value") < 5, 0.0).otherwise(1.0).alias("value"),
    )


@query(
    f"""SELECT job, metric, CAST(value AS DOUBLE) AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY job, metric ORDER BY ts DESC, event_id DESC) AS rn
          FROM ({METRICS_SQL})) WHERE rn = 1"""
)
def latest_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_status(_metrics(spark, sf_dir), "event_id")


@query(f"SELECT epoch_us(ts) AS ts, job, value FROM ({METRICS_SQL}) WHERE metric = 'duration_seconds'")
def run_duration_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.duration_series(_metrics(spark, sf_dir), "duration_seconds").withColumn("ts", F.unix_micros("ts"))


# Result status by event number modulo 5.
STATUSES = ("pass", "fail", "error", "skipped", "warn")


@query(
    """SELECT event_type AS job, 'test_failures' AS metric,
              count(*) FILTER (user_id % 2 = 0 AND event_id % 5 IN (1, 2, 4)) AS value
       FROM events GROUP BY event_type"""
)
def test_failure_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (F.col("event_id") % 5 + 1).cast("int"))
    results = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"),
        F.when(F.col("user_id") % 2 == 0, "test").otherwise("model").alias("kind"),
        status.alias("status"),
    )
    return runs.failed_tests(results).select("job", F.lit("test_failures").alias("metric"), "value")


@query(
    """WITH ends AS (SELECT event_type AS topic, user_id % 8 AS p, count(*) AS n FROM events GROUP BY ALL),
            done AS (SELECT event_type AS topic, user_id % 8 AS p, count(*) AS n FROM events
                     WHERE ts < TIMESTAMP '2024-01-20 00:00:00' AND user_id % 8 <> 3 GROUP BY ALL)
       SELECT 'sink-' || topic AS grp, topic, CAST(sum(greatest(e.n - coalesce(d.n, 0), 0)) AS BIGINT) AS lag
       FROM ends e LEFT JOIN done d USING (topic, p) GROUP BY topic"""
)
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic per event type with eight partitions; groups stopped on a day and never read partition 3."""
    messages = table(spark, sf_dir, "events").select(
        F.concat(F.lit("sink-"), F.col("event_type")).alias("grp"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 8).alias("partition"),
        "ts",
    )
    where = ["grp", "topic", "partition"]
    ends = messages.groupBy(*where).agg(F.count("*").alias("end_offset"))
    read = messages.where("ts < timestamp_ntz'2024-01-20 00:00:00' AND partition <> 3")
    return runs.consumer_lag(ends, read.groupBy(*where).agg(F.count("*").alias("committed_offset")))


@query(
    """SELECT quantile_cont(latency, 0.5) AS p50, quantile_cont(latency, 0.95) AS p95
       FROM (SELECT CAST(round(value * 100) AS BIGINT) AS latency FROM events)"""
)
def cdc_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of an event, in hundredths, taken as its way to the raw table in milliseconds."""
    source_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return runs.latency_percentiles(
        table(spark, sf_dir, "events").select(
            source_ms.alias("source_ms"),
            (source_ms + F.round(F.col("value") * 100).cast("bigint")).alias("ingest_ms"),
        )
    )


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, true AS p50_within, true AS p95_within
       FROM events GROUP BY ALL"""
)
def latency_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each day from stored sketches of its hours, held against the values themselves."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("bigint").alias("latency")
    )
    hourly = materialise(sketches.interval_sketches(events, "latency", "ts"), "sketches")
    wanted = {"p50": 0.5, "p95": 0.95}
    daily = sketches.merged_percentiles(hourly, wanted)
    compared = events.withColumn("start", F.date_trunc("day", "ts")).join(daily, "start")
    counts = [F.count_if(F.expr(f"latency {op} {p}")).alias(f"{p}_{side}") for p in wanted for op, side in (("<", "below"), ("<=", "upto"))]
    ranked = compared.groupBy("start", "n").agg(*counts)
    within = [
        ((F.col(f"{p}_below") <= (share + sketches.RANK_ERROR) * F.col("n")) & (F.col(f"{p}_upto") >= (share - sketches.RANK_ERROR) * F.col("n"))).alias(f"{p}_within")
        for p, share in wanted.items()
    ]
    return ranked.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n", *within)


POSITIONS_SQL = """
    SELECT 'events' AS topic, CASE WHEN event_id % 10 < 7 THEN 0 ELSE event_id % 10 - 6 END AS part,
           CASE WHEN event_id % 10 < 7 THEN event_id // 10 * 7 + event_id % 10 ELSE event_id // 10 END AS o
    FROM events"""


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of one topic; its first partition holds most of them."""
    last = F.col("event_id") % 10
    tens = F.floor(F.col("event_id") / 10)
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.when(last < 7, 0).otherwise(last - 6).cast("int").alias("partition"),
        F.when(last < 7, tens * 7 + last).otherwise(tens).alias("offset"),
    )


@query(
    f"""WITH sent AS ({POSITIONS_SQL}),
            landed AS (SELECT * FROM sent WHERE o % 97 NOT BETWEEN 10 AND 14 AND NOT (part = 0 AND o BETWEEN 150 AND 400)
                       UNION ALL SELECT * FROM sent WHERE o % 61 IN (5, 6) AND o % 97 NOT BETWEEN 10 AND 14 AND NOT (part = 0 AND o BETWEEN 150 AND 400)),
            ends AS (SELECT topic, part, min(o) - 2 AS lo, max(o) + 4 AS hi FROM sent GROUP BY ALL),
            expected AS (SELECT topic, part, unnest(range(lo, hi)) AS o FROM ends),
            faults AS (SELECT topic, part, 'missing' AS kind, o, 1 AS n FROM expected ANTI JOIN landed USING (topic, part, o)
                       UNION ALL SELECT topic, part, 'doubled', o, count(*) - 1 FROM landed GROUP BY topic, part, o HAVING count(*) > 1),
            runs AS (SELECT *, o - row_number() OVER (PARTITION BY topic, part, kind ORDER BY o) AS run FROM faults)
       SELECT topic, CAST(part AS INTEGER) AS part, kind, min(o) AS first, max(o) AS last, CAST(sum(n) AS BIGINT) AS n
       FROM runs GROUP BY topic, part, kind, run"""
)
def position_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some offsets never land, one long range too, and some land twice."""
    sent = _positions(spark, sf_dir)
    ends = sent.groupBy("topic", "partition").agg((F.min("offset") - 2).alias("begin"), (F.max("offset") + 4).alias("finish"))
    lost = F.expr("offset % 97 BETWEEN 10 AND 14 OR (partition = 0 AND offset BETWEEN 150 AND 400)")
    copies = F.when(F.col("offset") % 61 == 5, 2).when(F.col("offset") % 61 == 6, 2).otherwise(1)
    landed = sent.where(~lost).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return positions.position_audit(landed, ends).withColumnRenamed("partition", "part")
