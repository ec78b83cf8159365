"""Percentiles over time from stored sketches: one per interval, merged into longer ones without the values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, some 15 kB, and the error of a rank that it keeps within, as a share of all values.
SKETCH_K = 800
RANK_ERROR = 0.01


def interval_sketches(values: DataFrame, value: str, at: str, interval: str = "hour", by: Sequence[str] = ()) -> DataFrame:
    """``start, n, sketch`` per ``interval`` of the timestamp ``at`` and ``by``: a quantile sketch of the whole numbers ``value``.

    Values are sketched before the shuffle, so an interval with any share of them costs one sketch per task. NULL values
    and times are left out; an interval without values has no row.
    """
    present = values.where(F.col(value).isNotNull() & F.col(at).isNotNull())
    start = F.date_trunc(interval, F.col(at)).alias("start")
    return present.groupBy(start, *by).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(SKETCH_K)).alias("sketch")
    )


def merged_percentiles(sketches: DataFrame, probabilities: Mapping[str, float], interval: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """``start, n`` and a column per probability for longer intervals, from the sketches of :func:`interval_sketches`.

    A percentile is one of the values; the share of values up to it differs from the probability by
    :data:`RANK_ERROR` at most, with a probability of over 99 %, however many sketches are merged.
    """
    start = F.date_trunc(interval, F.col("start")).alias("start")
    merged = sketches.groupBy(start, *by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("sketch"))
    quantiles = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
    return merged.select("start", *by, "n", *quantiles)
