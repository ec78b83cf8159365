"""Did everything that was sent arrive?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def arrivals(expected: DataFrame, arrived: DataFrame, on: list[str]) -> DataFrame:
    """Expected rows with how many matching rows arrived; only expected ones are counted, and before the join."""
    wanted = arrived.join(expected.select(*on).distinct(), on, "left_semi")
    counted = wanted.groupBy(*on).agg(F.count("*").alias("arrived"))
    return expected.join(counted, on, "left").withColumn("arrived", F.coalesce("arrived", F.lit(0)))


def arrival_check(expected: DataFrame, bronze: DataFrame, key: str, field: str) -> DataFrame:
    """Whether each expected (key, value) pair is already in the raw log."""
    arrived = bronze.select(F.col(f"after.{key}").alias(key), F.col(f"after.{field}").alias(field))
    return arrivals(expected, arrived, [key, field]).withColumn(
        "verdict", F.when(F.col("arrived") > 0, "arrived").otherwise("waiting")
    )


def reconcile_markers(expected: DataFrame, bronze: DataFrame, field: str, prefix: str) -> DataFrame:
    """Marker rows against the raw log: ``lost``, ``ok`` or, as delivery repeats, ``duplicated``."""
    arrived = bronze.where(F.col(f"after.{field}").startswith(prefix)).select(
        F.col(f"after.{field}").alias("marker")
    )
    verdict = (
        F.when(F.col("arrived") < F.col("expected"), "lost")
        .when(F.col("arrived") > F.col("expected"), "duplicated")
        .otherwise("ok")
    )
    return arrivals(expected, arrived, ["marker"]).withColumn("verdict", verdict)
