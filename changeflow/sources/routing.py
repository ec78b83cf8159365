"""Which event belongs to which table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def include_tables(events: DataFrame, tables: Iterable[str], schema: str = "shop") -> DataFrame:
    """Only events of the listed tables of one schema."""
    return events.where((F.col("source.schema") == schema) & F.col("source.table").isin(*tables))


def route(events: DataFrame, tables: Iterable[str]) -> dict[str, DataFrame]:
    """One frame per table, chosen by the table named in the event, never by position."""
    return {t: events.where(F.col("source.table") == t) for t in tables}


def misrouted(landed: DataFrame, target: str = "target") -> DataFrame:
    """Events that lie in a target other than the table they came from, counted by the pair."""
    return (
        landed.where(~F.col(target).eqNullSafe(F.col("source.table")))
        .groupBy(F.col(target).alias("target"), F.col("source.table").alias("source_table"))
        .agg(F.count("*").alias("n"))
    )
