"""Change capture from table snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changeflow.operators.evolve import to_schema, unified_schema
from changeflow.session import materialise
from changeflow.sources.envelope import event_key, source_struct


def read_jdbc_snapshot(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A source table read in parallel ranges of its integer key."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=options
    )


def snapshot_envelopes(rows: DataFrame, table: str, ts_ms: Column, lsn: Column) -> DataFrame:
    """Every row of a snapshot as a read event, as sent when a capture starts or is reset."""
    image = F.struct(*[F.col(c) for c in rows.columns])
    return rows.select(
        F.lit(None).cast(rows.schema).alias("before"),
        image.alias("after"),
        F.lit("r").alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
        source_struct(table, lsn, ts_ms).alias("source"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """What leads from one snapshot to the next, per key: k, op, before, after.

    A full outer join by key over the unified schema, so columns that came or went count as changes and
    images have the columns of both. ``op`` is ``c``, ``u`` or ``d``, or ``?`` where a snapshot holds a key more than
    once: then the images are one row of each side. Both sides are counted, ordered and joined on one shuffle.
    """
    schema = unified_schema(old.schema, new.schema)
    order = [key, *[f.name for f in schema if f.name != key]]

    def side(rows: DataFrame, name: str) -> DataFrame:
        row = to_schema(rows, schema).select(F.col(key).alias("k"), F.struct(*order).alias(name))
        by_key = W.partitionBy("k")
        nth = F.row_number().over(by_key.orderBy(F.xxhash64(name)))
        return row.withColumns({f"n_{name}": F.count("*").over(by_key), "nth": nth}).where("nth = 1").drop("nth")

    op = (
        F.when((F.col("n_before") > 1) | (F.col("n_after") > 1), "?")
        .when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    joined = side(old, "before").join(side(new, "after"), "k", "full")
    return joined.withColumn("op", op).where(F.col("op").isNotNull()).select("k", "op", "before", "after")


def apply_changes(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The snapshot after the given changes, at most one per key, in the columns the changes know.

    Keys that are in question keep their old rows.
    """
    clear = changes.where("op <> '?'")
    kept = to_schema(old.join(clear.select(F.col("k").alias(key)), key, "left_anti"), changes.schema["after"].dataType)
    return kept.unionByName(clear.where("op <> 'd'").select("after.*"))


def chunk_of(key: Column, size: int) -> Column:
    """The number of the key range of ``size`` that a key lies in; the null key has a chunk of its own."""
    return F.coalesce(F.floor(key / size), F.lit(-(2**62)).cast("bigint"))


def merge_snapshot(rows: DataFrame, windows: DataFrame, log: DataFrame, key: str, size: int, table: str) -> DataFrame:
    """Envelopes of a snapshot that was read chunk by chunk while the log ran on, and of that log.

    ``rows`` are the rows as read. ``windows`` has for each chunk of keys (:func:`chunk_of`) the log's positions before and after
    it was read, ``chunk, low, high``, each a struct ``ts_ms, lsn``; ``log`` holds every event after the lowest ``low``. A row whose
    key has an event in its chunk's window may be older or newer than that event, so it is dropped: the event holds the
    whole row. All others were the same throughout the window; they become read events at its end, later than what
    they show and earlier than what follows. Each chunk depends on its own window only. Rows of a chunk without a window
    are not taken.
    """
    place = F.struct(F.col("ts_ms"), F.col("source.lsn").alias("lsn"))
    moved = log.select(event_key(key).alias("moved"), place.alias("at")).withColumn("chunk", chunk_of(F.col("moved"), size))
    moved = moved.join(windows, "chunk").where((F.col("at") > F.col("low")) & (F.col("at") <= F.col("high"))).select("moved").distinct()
    still = rows.join(moved, F.col(key).eqNullSafe(F.col("moved")), "left_anti")
    image = F.struct(*[F.col(c) for c in rows.columns])
    read = still.select(chunk_of(F.col(key), size).alias("chunk"), image.alias("row")).join(windows.select("chunk", "high"), "chunk")
    return read.select(
        F.lit(None).cast(rows.schema).alias("before"),
        F.col("row").alias("after"),
        F.lit("r").alias("op"),
        F.col("high.ts_ms").cast("bigint").alias("ts_ms"),
        source_struct(table, F.col("high.lsn"), F.col("high.ts_ms")).alias("source"),
    ).unionByName(log.select("before", "after", "op", "ts_ms", "source"))


#: Ranges that a span of keys is cut into, twice over: the first are compared before the second.
RANGES = 1024


def row_digests(rows: DataFrame, *by: str) -> DataFrame:
    """``n, d0 .. d3`` per group of rows (``row``, a struct): sums of two 64-bit hashes of each row, by halves, in any order.

    Hashing passes over NULL, so which columns are NULL is hashed as well.
    """
    fields = [F.col(f"row.{f}") for f in rows.schema["row"].dataType.names]
    nulls = F.concat(*[F.when(f.isNull(), "1").otherwise("0") for f in fields])
    one, two = F.xxhash64(nulls, *fields), F.xxhash64(*fields, nulls, F.lit(1))
    halves = [h for x in (one, two) for h in (F.shiftright(x, 32), x.bitwiseAND(0xFFFFFFFF))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(h).alias(f"d{i}") for i, h in enumerate(halves)])


def differing(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """The values of ``by`` whose rows differ between the two sides."""
    facts = ("n", "d0", "d1", "d2", "d3")
    sides = [row_digests(x, by).select(F.col(by).alias(f"{by}_{s}"), F.struct(*facts).alias(s)) for x, s in ((old, "a"), (new, "b"))]
    met = sides[0].join(sides[1], F.col(f"{by}_a").eqNullSafe(F.col(f"{by}_b")), "full")
    # the null key is a key like any other, so a side that is not there is told by its digest
    value = F.when(F.col("a").isNull(), F.col(f"{by}_b")).otherwise(F.col(f"{by}_a"))
    return met.where(~F.col("a").eqNullSafe(F.col("b"))).select(value.alias(by))


def snapshot_diff_by_range(old: DataFrame, new: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """:func:`snapshot_diff` where most of the rows are alike: only rows of key ranges that differ are shuffled and joined.

    The span of the integer ``key`` is cut into ``ranges`` ranges, and each of those again. Both sides are digested per range, with
    map-side combine, and compared: first the large ranges, then the small ones within those that differ. There are at most
    ``ranges`` of the first and its square of the second, which bounds what is sent to the tasks to choose rows by. At last the keys are
    compared: one whose rows are alike on both sides is not reported, however often it comes.
    """
    schema = unified_schema(old.schema, new.schema)
    names = [key, *[f.name for f in schema if f.name != key]]
    ends = old.select(key).union(new.select(key)).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, width = ends.lo or 0, 1 + ((ends.hi or 0) - (ends.lo or 0)) // ranges**2
    small = F.coalesce(F.floor((F.col(key) - lo) / width), F.lit(-1))

    def side(rows: DataFrame) -> DataFrame:
        rows = to_schema(rows, schema).withColumn("row", F.struct(*names)).select(F.col(key).alias("k"), "row", small.alias("small"))
        return rows.withColumn("large", F.floor(F.col("small") / ranges))

    sides = [side(old), side(new)]
    for level in ("large", "small"):
        chosen = materialise(differing(*sides, level), level)
        sides = [s.join(F.broadcast(chosen), level, "left_semi") for s in sides]
    keys = differing(*[s.select("k", "row") for s in sides], "k").withColumnRenamed("k", "changed")
    found = snapshot_diff(*[s.select("row.*") for s in sides], key)
    return found.join(keys, F.col("k").eqNullSafe(F.col("changed")), "left_semi")
