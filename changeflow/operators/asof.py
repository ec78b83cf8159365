"""As-of join: to each event the values that were valid at its position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def asof_join(events: DataFrame, versions: DataFrame, key: str, at: str, since: str, values: Sequence[str], width: int) -> DataFrame:
    """``events`` with ``values`` of the last of ``versions`` of the same ``key`` whose ``since`` is not after ``at``.

    Values are NULL where there is none, and for a null key or position. Of versions that begin at one position the one with
    the largest values counts. Positions are cut into stretches of ``width``; events and versions of a stretch are sorted
    together, and every stretch that holds events begins with what was valid before it. So a key with any share of all events is
    spread over its stretches, and what one task sees of a key at once is its list of stretches, not its events.
    """
    stretch = lambda c: F.floor(F.col(c) / width)
    row, held = F.struct(*events.columns), F.struct(*values)
    none_row, none_held = F.lit(None).cast(events.select(row.alias("r")).schema["r"].dataType), F.lit(None).cast(versions.select(held.alias("h")).schema["h"].dataType)
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    sent = events.where(placed).select(
        F.col(key).alias("k"), stretch(at).alias("stretch"), F.col(at).cast("bigint").alias("at"), F.lit(1).alias("kind"), none_held.alias("held"), row.alias("row")
    )
    marks = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("k"), stretch(since).alias("stretch"), F.col(since).cast("bigint").alias("at"), F.lit(0).alias("kind"), held.alias("held"), none_row.alias("row")
    )
    begins = sent.select("k", "stretch").distinct().select("k", "stretch", F.lit(None).cast("bigint").alias("at"), F.lit(-1).alias("kind"), none_held.alias("held"), none_row.alias("row"))

    def so_far(*by: str) -> W:
        order = [c for c in ("stretch", "at", "kind", "held") if c not in by]
        return W.partitionBy(*by).orderBy(*[F.asc_nulls_first(c) for c in order]).rowsBetween(W.unboundedPreceding, 0)

    carried = begins.unionByName(marks).withColumn("held", F.last("held", True).over(so_far("k"))).where("kind = -1")
    joined = sent.unionByName(marks).unionByName(carried).withColumn("held", F.last("held", True).over(so_far("k", "stretch")))
    found = joined.where("kind = 1").select("row.*", *[F.col(f"held.{v}").alias(v) for v in values])
    kinds = {f.name: f.dataType for f in versions.schema}
    unplaced = events.where(~placed | placed.isNull()).withColumns({v: F.lit(None).cast(kinds[v]) for v in values})
    return found.unionByName(unplaced)
