"""Percentiles from merged sketches against the values."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from changeflow.functions.quantiles import exact_percentiles
from changeflow.functions.sketches import RANK_ERROR, interval_sketches, merged_percentiles

WANTED = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p999": 0.999}


def within(values, got):
    for name, p in WANTED.items():
        below, upto = sum(v < got[name] for v in values) / len(values), sum(v <= got[name] for v in values) / len(values)
        assert below <= p + RANK_ERROR and upto >= p - RANK_ERROR, (name, below, upto)


@pytest.mark.parametrize("shape", ["even", "tail", "one value"])
def test_days_from_hours(spark, shape):
    random.seed(shape)
    draw = {"even": lambda: random.randrange(10**6), "tail": lambda: int(random.paretovariate(1.1)), "one value": lambda: random.choice([7] * 9 + [1, 10**9])}[shape]
    begin = datetime.datetime(2026, 8, 12)
    rows = [(begin + datetime.timedelta(seconds=random.randrange(3 * 86_400)), draw()) for _ in range(30_000)]
    rows += [(begin, None), (None, 5)]
    df = spark.createDataFrame(rows, "ts timestamp, v bigint").repartition(6)
    hourly = interval_sketches(df, "v", "ts")
    assert hourly.count() == 72
    daily = {r.start: r for r in merged_percentiles(hourly, WANTED).collect()}
    for day in range(3):
        start = begin + datetime.timedelta(days=day)
        values = [v for t, v in rows if t is not None and v is not None and t.date() == start.date()]
        assert daily[start].n == len(values)
        within(values, daily[start])


def test_groups_stay_apart_and_small_ones_are_exact(spark):
    begin = datetime.datetime(2026, 8, 12)
    rows = [(begin, g, i * (1 if g == "a" else 1000)) for g in "ab" for i in range(101)]
    df = spark.createDataFrame(rows, "ts timestamp, g string, v bigint")
    got = {r.g: r for r in merged_percentiles(interval_sketches(df, "v", "ts", by=["g"]), {"p50": 0.5}, by=["g"]).collect()}
    for g in "ab":
        exact = exact_percentiles(df.where(F.col("g") == g), "v", {"p50": 0.5}).first().p50
        assert got[g].p50 == exact and got[g].n == 101


def test_no_values(spark):
    empty = spark.createDataFrame([(None, None)], "ts timestamp, v bigint")
    assert merged_percentiles(interval_sketches(empty, "v", "ts"), WANTED).isEmpty()
