"""Exact percentiles without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16


def exact_percentiles(df: DataFrame, value: str, wanted: dict[str, float]) -> DataFrame:
    """One row with a linearly interpolated percentile of a bigint column per output name.

    Each percentile lies between the values at two ranks. Those are found digit by digit: rows are
    counted by their next 16 bits (combined on the map side, so a rank never sees more than 65,536
    counters per step), and the digit at which the running count passes the rank is kept. NULLs are
    ignored; no rows give NULLs.
    """
    # typed as never NULL, so that no step adds a null test of its own below the shared count
    known = F.coalesce(F.col(value), F.lit(0)).alias("v")
    counts = df.where(F.col(value).isNotNull()).groupBy(known).agg(F.count("*").alias("n"))

    ends = ", ".join(
        f"named_struct('name', '{name}', 'at_end', {end}, 'p', {float(p)!r}D)"
        for name, p in wanted.items()
        for end in (0, 1)
    )
    total = "sum(n) OVER (PARTITION BY name, at_end)"
    found = (
        counts.groupBy(F.shiftright("v", 64 - DIGIT_BITS).alias("digit"))
        .agg(F.sum("n").alias("n"))
        .selectExpr("digit", "n", f"inline(array({ends}))")
        .withColumn("at", F.expr(f"p * ({total} - 1)"))
        .withColumn("rank", F.expr("if(at_end = 0, floor(at), ceil(at))"))
        .withColumn("weight", F.expr("at - floor(at)"))
        .transform(_pass_rank)
    )
    for bits in range(2 * DIGIT_BITS, 65, DIGIT_BITS):
        # two rows per wanted percentile, so this broadcast has a fixed size
        found = (
            counts.select(
                F.shiftright("v", 64 - bits + DIGIT_BITS).alias("prefix"), F.shiftright("v", 64 - bits).alias("digit"), "n"
            )
            .join(F.broadcast(found), "prefix")
            .groupBy("name", "at_end", "rank", "weight", "digit")
            .agg(F.sum("n").alias("n"))
            .transform(_pass_rank)
        )

    def at(name: str, column: str, end: int) -> str:
        return f"max({column}) FILTER (WHERE name = '{name}' AND at_end = {end})"

    return found.selectExpr(
        *[
            f"{at(n, 'prefix', 0)} + ({at(n, 'prefix', 1)} - {at(n, 'prefix', 0)}) * {at(n, 'weight', 0)} AS {n}"
            for n in wanted
        ]
    )


def _pass_rank(digits: DataFrame) -> DataFrame:
    """Per rank, the digit that holds it and the rank left within that digit."""
    upto = "sum(n) OVER (PARTITION BY name, at_end ORDER BY digit)"
    return (
        digits.withColumn("upto", F.expr(upto))
        .where("upto > rank AND upto - n <= rank")
        .selectExpr("name", "at_end", "rank - upto + n AS rank", "weight", "digit AS prefix")
    )
