"""Left joins to a keyed table when a few keys hold much of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of all rows, so there are fewer than ``1 / HOT_SHARE`` of them.
HOT_SHARE = 1 / 2000


def hot_from_counts(counts: DataFrame, key: str, n: str, share: float = HOT_SHARE) -> DataFrame:
    """``(key, salts)`` of the keys that hold more than ``share`` of the rows that ``n`` counts.

    ``salts`` splits a key into parts of at most ``share`` of all rows, so parts are as even at any size.
    """
    most = F.sum(n) * share
    limit = counts.agg(most.alias("most")).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col(n) > limit)).select(
        key, F.ceil(F.col(n) / limit).cast("int").alias("salts")
    )


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys with more than ``share`` of the rows, counted with map-side combine."""
    return hot_from_counts(facts.groupBy(key).agg(F.count("*").alias("n")), key, "n", share)


def salted_left_join(facts: DataFrame, dim: DataFrame, key: str, spread_by: str, hot: DataFrame) -> DataFrame:
    """``facts`` left join ``dim`` (unique on ``key``), with hot keys split over as many tasks as they need.

    A hot key's rows take a salt from ``spread_by`` and its ``dim`` row is repeated per salt. Rows
    without a key match nothing and are spread over as many salts as one key can have. ``hot`` only
    decides where rows go: any set of keys gives the same result. It is broadcast because shares add
    up to one, which bounds it at ``1 / share`` keys.
    """
    marks = F.broadcast(hot.select(F.col(key), "salts"))
    salts = F.when(F.col(key).isNull(), round(1 / HOT_SHARE)).otherwise(F.coalesce("salts", F.lit(1)))
    left = facts.join(marks, key, "left").withColumn("salt", F.pmod(F.xxhash64(spread_by), salts).cast("int"))
    every_salt = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    right = dim.join(marks, key, "left").withColumn("salt", F.explode(every_salt))
    return left.drop("salts").join(right.drop("salts"), [key, "salt"], "left").drop("salt")
