"""Loss and duplication of messages by their positions in the topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Offsets of a stretch: as many as a bitmap of Spark's holds.
STRETCH = 32768
LOG = ("topic", "partition")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges (``topic, partition, kind, first, last, n``) of one kind that follow one another without a gap, as one."""
    order = W.partitionBy(*LOG, "kind").orderBy("first")
    begins = F.coalesce(F.col("first") > F.lag("last").over(order) + 1, F.lit(True))
    island = F.sum(begins.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))
    return (
        ranges.withColumn("island", island)
        .groupBy(*LOG, "kind", "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
        .drop("island")
    )


def position_audit(landed: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """``topic, partition, kind, first, last, n``: ranges of offsets that are ``missing`` from ``landed`` or ``doubled`` in it.

    ``n`` counts the messages that are missing, or those beyond the first of their offset. ``bounds`` (``topic, partition, begin,
    finish``) tells what a partition's log holds, ``finish`` excluded; without it, only what lies between its least and
    greatest landed offset can be missed. Rows without a position are not judged.

    Offsets are counted in stretches, in a bitmap each, before anything is shuffled. What is whole needs no more than that. Only
    the offsets of stretches with a fault are looked at one by one, each stretch in its task; what lies between two stretches
    comes from their ends, and ranges that touch are merged. A partition of any length is spread over its stretches.
    """
    placed = landed.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL").select(
        "topic", "partition", F.col("offset").cast("bigint").alias("offset"), F.floor(F.col("offset") / STRETCH).alias("stretch")
    )
    bit = (F.col("offset") - F.col("stretch") * STRETCH).cast("bigint")
    counts = placed.groupBy(*LOG, "stretch").agg(
        F.count("*").alias("n"),
        F.bitmap_count(F.bitmap_construct_agg(bit)).alias("seen"),
        F.min("offset").alias("lo"),
        F.max("offset").alias("hi"),
    )

    def ranges(found: DataFrame, kind: str, first: Column, last: Column, n: Column) -> DataFrame:
        return found.select(*LOG, F.lit(kind).alias("kind"), first.alias("first"), last.alias("last"), n.cast("bigint").alias("n"))

    def gaps(found: DataFrame, first: Column, last: Column) -> DataFrame:
        return ranges(found, "missing", first, last, last - first + 1).where("n > 0")

    by_stretch = W.partitionBy(*LOG).orderBy("stretch")
    between = gaps(counts.withColumn("next", F.lead("lo").over(by_stretch)).where("next IS NOT NULL"), F.col("hi") + 1, F.col("next") - 1)
    faulty = counts.where("n > seen OR seen < hi - lo + 1").select(*LOG, "stretch")
    offsets = placed.join(faulty, [*LOG, "stretch"], "left_semi").groupBy(*LOG, "stretch", "offset").agg(F.count("*").alias("n"))
    by_offset = W.partitionBy(*LOG, "stretch").orderBy("offset")
    inside = gaps(offsets.withColumn("next", F.lead("offset").over(by_offset)).where("next IS NOT NULL"), F.col("offset") + 1, F.col("next") - 1)
    twice = offsets.where("n > 1").withColumn("run", F.col("offset") - F.row_number().over(by_offset))
    twice = twice.groupBy(*LOG, "stretch", "run").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum(F.col("n") - 1).alias("n"))
    found = [between, inside, ranges(twice, "doubled", F.col("first"), F.col("last"), F.col("n"))]
    if bounds is not None:
        ends = counts.groupBy(*LOG).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        known = bounds.join(ends, list(LOG), "left")
        # a partition of which nothing landed is missing whole
        found.append(gaps(known, F.col("begin"), F.least(F.coalesce(F.col("lo"), F.col("finish")), F.col("finish")) - 1))
        found.append(gaps(known.where("hi IS NOT NULL"), F.greatest(F.col("hi") + 1, F.col("begin")), F.col("finish") - 1))
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f)
    return merged_ranges(whole)
