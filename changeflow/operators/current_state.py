"""Latest state per key from an append-only, at-least-once, possibly disordered change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.sources.envelope import event_key


def flat_events(bronze: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Events as plain rows: key, the new row's fields, op, ts_ms, lsn."""
    return bronze.selectExpr(
        f"coalesce(after.{key}, before.{key}) AS {key}",
        *[f"after.{f} AS {f}" for f in fields],
        "op",
        "ts_ms",
        "source.lsn AS lsn",
    )


def newest_per_key(flat: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The newest flat event of every key, deletes included.

    Catalyst turns the rank filter into a group limit before the shuffle, so a map task sends one event
    per key it saw, however hot the key is. Events that no position tells apart are ordered by content,
    so a rerun gives the same row.
    """
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ("ts_ms", "lsn", "op", *fields))
    rank = f"row_number() OVER (PARTITION BY {key} ORDER BY {newest})"
    return flat.withColumn("rn", F.expr(rank)).where("rn = 1").drop("rn")


def latest_events(bronze: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The newest event of every key; only the needed leaves of the images are read."""
    return newest_per_key(flat_events(bronze, key, fields), key, fields)


def current_state(bronze: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row per live key. A key whose newest event is a delete, or has no code, is gone."""
    return latest_events(bronze, key, fields).where("op <> 'd'").select(key, *fields)


def deleted_keys(bronze: DataFrame, key: str) -> DataFrame:
    """Keys whose newest event is a delete, with its time."""
    return latest_events(bronze, key, ()).where("op = 'd'").select(key, "ts_ms")


def current_state_by_max(bronze: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The same rows as :func:`current_state`, as an aggregate.

    Ranking is refused on streams, this form is not. NULL times lose against any time because the
    ordering struct compares NULL as smallest.
    """
    content = ", ".join(["op", *[f"after.{f} AS {f}" for f in fields]])
    newest = f"max_by(struct({content}), struct(ts_ms, source.lsn AS lsn, {content}))"
    return (
        bronze.groupBy(event_key(key).alias(key))
        .agg(F.expr(newest).alias("e"))
        .where("e.op <> 'd'")
        .selectExpr(key, *[f"e.{f} AS {f}" for f in fields])
    )
