"""The change event: both row images, an operation code, a time and a log position.

``op`` is ``c`` (insert), ``u`` (update), ``d`` (delete) or ``r`` (snapshot read). ``before`` holds the
full old row on update and delete, ``after`` is NULL on delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = "schema string, table string, lsn bigint, ts_ms bigint"


def envelope_schema(image: str) -> T.StructType:
    """Envelope around a row image given as a DDL column list."""
    return T.StructType.fromDDL(
        f"before struct<{_nested(image)}>, after struct<{_nested(image)}>, op string, ts_ms bigint, "
        f"source struct<{_nested(SOURCE)}>"
    )


def _nested(columns: str) -> str:
    return ", ".join(": ".join(c.strip().split(" ", 1)) for c in columns.split(","))


def source_struct(table: str | Column, lsn: Column, ts_ms: Column, schema: str = "shop") -> Column:
    return F.struct(
        F.lit(schema).alias("schema"),
        (F.lit(table) if isinstance(table, str) else table).alias("table"),
        lsn.cast("bigint").alias("lsn"),
        ts_ms.cast("bigint").alias("ts_ms"),
    )


def event_key(key: str) -> Column:
    """The row's identity; on a delete it survives only in ``before``."""
    return F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))


def key_recovery(bronze: DataFrame, key: str) -> DataFrame:
    """Per key, how many events gave it through ``after`` and how many only through ``before``."""
    in_after = F.col(f"after.{key}").isNotNull()
    return (
        bronze.groupBy(event_key(key).alias("k"))
        .agg(
            F.count_if(in_after).alias("from_after"),
            F.count_if(~in_after & F.col(f"before.{key}").isNotNull()).alias("from_before"),
        )
    )


def op_counts(bronze: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return bronze.groupBy(*by, "op").agg(F.count("*").alias("n"))


def preview(bronze: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first events by key and position; every task only keeps its own first few."""
    return (
        bronze.select(event_key(key).alias(key), "op", "ts_ms", F.col("source.lsn").alias("lsn"))
        .orderBy(key, "lsn", "ts_ms", "op")
        .limit(rows)
    )
